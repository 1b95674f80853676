"""Quotation linking (operator 1). SQL functions only.

Messages that quote others mark the quoted lines with ``>`` per level. Each message is taken
apart into blocks of one level; the quoted passages are normalised and hashed and joined to the
messages that say the same in their own words, per block and, for quotes of a part, per line. The
message that holds most of what a reply quotes at its outermost level is its parent. Threads are
ordered so that replies stand below what they answer, and the messages come without quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

#: Quote marks at a line's start, with blanks before and between.
QUOTE = r"^[\x20\t]*(?:>[\x20\t]?)+"
#: A line that only announces a quote ("On ... wrote:") goes with the quote below it.
INTRO = r"^.{0,200}\b(?:wrote|writes|schrieb|escribió|a écrit)\s*:\s*$"
#: Characters that a normalised passage must have to tell where it comes from.
LEAST = 12
#: Rounds in which paths to the thread's start are doubled: 2^ROUNDS replies deep at most.
ROUNDS = 40


def normalised(text: Column) -> Column:
    """Lower case, letters and digits only, single blanks between words."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _hash(text: Column) -> Column:
    return F.when(F.length(normalised(text)) >= LEAST, F.xxhash64(normalised(text)))


def _lines(text: Column) -> Column:
    """(level, said) per line: the number of quote marks and the line without them."""

    def line(raw: Column) -> Column:
        marks = F.regexp_extract(raw, QUOTE, 0)
        return F.struct(F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"), F.substr(raw, F.length(marks) + 1).alias("said"))

    return F.transform(F.split(text, r"\r?\n"), line)


def _blocks(lines: Column) -> Column:
    """Runs of lines of one level: (level, text)."""
    none = F.array().cast("array<struct<level: int, text: string>>")

    def step(state: Column, line: Column) -> Column:
        same = (F.size(state["done"]) + F.size(state["open"]) > 0) & (state["level"] == line["level"])
        opened = F.when(same, F.concat(state["open"], F.array(line["said"]))).otherwise(F.array(line["said"]))
        closed = F.when(same | (F.size(state["open"]) == 0), state["done"]).otherwise(F.concat(state["done"], F.array(_block(state))))
        return F.struct(line["level"].alias("level"), opened.alias("open"), closed.alias("done"))

    def _block(state: Column) -> Column:
        return F.struct(state["level"].alias("level"), F.array_join(state["open"], "\n").alias("text"))

    start = F.struct(F.lit(0).alias("level"), F.array().cast("array<string>").alias("open"), none.alias("done"))
    return F.aggregate(lines, start, step, lambda s: F.when(F.size(s["open"]) > 0, F.concat(s["done"], F.array(_block(s)))).otherwise(s["done"]))


def _passages(blocks: Column, quoted: bool) -> Column:
    """Hashes of the blocks and of their lines: (level, weight, hash); the weight is the length."""
    chosen = F.filter(blocks, lambda b: (b["level"] > 0) if quoted else (b["level"] == 0))

    def pieces(block: Column) -> Column:
        paragraphs = F.split(block["text"], r"\n[\x20\t]*\n")
        whole = F.concat(F.array(block["text"]), paragraphs, F.split(block["text"], "\n"))
        return F.transform(F.array_distinct(whole), lambda t: F.struct(block["level"].alias("level"), F.length(normalised(t)).alias("weight"), _hash(t).alias("hash")))

    return F.array_distinct(F.filter(F.flatten(F.transform(chosen, pieces)), lambda p: p["hash"].isNotNull()))


def _own_words(blocks: Column) -> Column:
    """The text without quotes and without the lines that only announce one."""
    kept = F.filter(blocks, lambda b: b["level"] == 0)
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    said = F.filter(F.split(text, "\n"), lambda line: ~F.rlike(line, F.lit(INTRO)))
    return F.when(F.exists(blocks, lambda b: b["level"] > 0), F.trim(F.array_join(said, "\n"))).otherwise(text)


def link_quotes(messages: DataFrame) -> DataFrame:
    """Messages without quotes, in reply order.

    Input: conv_id, turn, role, text. Output, one row per message: conv_id, turn, role, text (own
    words), n_quoted (quoted passages), n_linked (those whose original was found), parent_conv_id
    and parent_turn (the message it replies to), depth (replies above it), reply_path (turns from
    the thread's start down to it; conv_id and reply_path sort a conversation in reply order).

    The original of a passage is the first message of the same conversation that says it before,
    else the first message of all that does; a passage of fewer than LEAST characters tells
    nothing. Of several originals that with the longest passages at the outermost level is the
    parent, then the latest turn. Threads follow parents within a conversation. A null or empty
    text quotes nothing and stays as it is. Messages with a null conv_id or turn are no originals
    and keep their place alone. Repeated rows share their links. Extra columns are not read.
    """
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text",
        _blocks(_lines(F.coalesce("text", F.lit("")))).alias("blocks"))
    keyed = rows.where("conv_id is not null and turn is not null")
    asked = keyed.where(F.exists("blocks", lambda b: b["level"] > 0))
    quotes = stored(asked.select("conv_id", "turn", F.explode(_passages(F.col("blocks"), True)).alias("p")).select("conv_id", "turn", "p.*").distinct())
    # Only what somebody quotes needs an original; equal passages of a conversation count once.
    said = keyed.select("conv_id", "turn", F.explode(_passages(F.col("blocks"), False)).alias("p")).select("conv_id", "turn", F.col("p.hash").alias("hash"))
    said = said.groupBy("hash", "conv_id").agg(F.min("turn").alias("first_turn"))
    said = stored(said.join(quotes.select("hash").distinct(), "hash", "left_semi"))
    # The first conversation that says it, and the first but that one: one of the two is another's.
    place = F.struct("conv_id", "first_turn")
    first = stored(said.groupBy("hash").agg(F.min(place).alias("far")))
    later = said.join(first, "hash").where(F.col("conv_id") != F.col("far.conv_id"))
    anywhere = first.join(later.groupBy("hash").agg(F.min(place).alias("next")), "hash", "left")
    near = said.select("hash", "conv_id", "first_turn")
    found = quotes.join(near, ["hash", "conv_id"], "left").join(anywhere, "hash", "left")
    here = F.col("first_turn") < F.col("turn")
    found = found.withColumn("far", F.when(F.col("far.conv_id") != F.col("conv_id"), F.col("far")).otherwise(F.col("next")))
    elsewhere = F.col("far").isNotNull()
    found = found.select(
        "conv_id", "turn", "level", "weight", "hash",
        F.when(here, F.col("conv_id")).when(elsewhere, F.col("far.conv_id")).alias("of_conv"),
        F.when(here, F.col("first_turn")).when(elsewhere, F.col("far.first_turn")).alias("of_turn"))
    told = found.groupBy("conv_id", "turn").agg(
        F.count_distinct("level", "hash").alias("n_quoted"),
        F.count_distinct(F.when(F.col("of_conv").isNotNull(), F.struct("level", "hash"))).alias("n_linked"))
    outer = found.where("of_conv is not null").groupBy("conv_id", "turn", "of_conv", "of_turn").agg(F.min("level").alias("level"), F.sum("weight").alias("weight"))
    best = F.max(F.struct((-F.col("level")).alias("outer"), (F.col("of_conv") == F.col("conv_id")).alias("here"), "weight", F.col("of_turn").alias("turn"), F.col("of_conv").alias("conv")))
    parents = stored(outer.groupBy("conv_id", "turn").agg(best.alias("best")).select("conv_id", "turn", F.col("best.conv").alias("parent_conv_id"), F.col("best.turn").alias("parent_turn")))
    linked = told.join(parents, ["conv_id", "turn"], "left").join(_paths(parents), ["conv_id", "turn"], "left")
    out = rows.join(linked, ["conv_id", "turn"], "left")
    path = F.coalesce("path", F.array("turn"))
    return out.select(
        "conv_id", "turn", "role", _own_words(F.col("blocks")).alias("clean"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_quoted", "n_linked")],
        "parent_conv_id", "parent_turn", (F.size(path) - 1).cast("long").alias("depth"),
        F.array_join(F.transform(path, lambda t: F.lpad(t.cast("string"), 19, "0")), "/").alias("reply_path"),
        F.col("text").isNull().alias("bare")).withColumn("text", F.when(~F.col("bare"), F.col("clean"))).drop("clean", "bare")


def _paths(parents: DataFrame) -> DataFrame:
    """Turns from the thread's start to each message with a parent in its conversation."""
    links = parents.where("parent_conv_id = conv_id")
    # top: the message the path starts at, which may have a parent itself.
    now = stored(links.select("conv_id", "turn", F.array("parent_turn", "turn").alias("path")))
    for _ in range(ROUNDS):
        above = now.select("conv_id", F.col("turn").alias("top"), F.col("path").alias("above"))
        longer = now.withColumn("top", F.col("path")[0]).join(above, ["conv_id", "top"], "left")
        whole = F.when(F.col("above").isNull(), F.col("path")).otherwise(F.concat(F.slice("above", 1, F.size("above") - 1), "path"))
        after = stored(longer.select("conv_id", "turn", whole.alias("path"), F.col("above").isNotNull().alias("grew")))
        now = after.select("conv_id", "turn", "path")
        if after.where("grew").isEmpty():
            break
    return now
