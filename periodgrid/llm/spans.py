"""Places of regex matches in whole texts, with SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Characters that mark matches while a text is taken apart; texts that hold them are read as if
#: they held \\u0002, which no pattern here matches.
MARK, FIELD, PLAIN = "\u0001", "\u0003", "\u0002"

SPAN = "struct<start: bigint, end: bigint, value: string, part: string>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def matches(text: Column, pattern: str | Column, part: int | None = None) -> Column:
    """Leftmost matches that do not overlap: array of (start, end, value, part), in characters.

    ``part`` is a group whose text is kept as well. Matches must not be empty. The text is cut
    at its matches, and the lengths of the pieces add up to the places: first within blocks of
    pieces, then over the blocks, as every step copies what it has found so far.
    """
    pattern = pattern if isinstance(pattern, Column) else F.lit(pattern)
    clean = F.translate(text, MARK + FIELD, PLAIN * 2)
    group = f"{FIELD}${part}" if part else ""
    pieces = F.split(F.regexp_replace(clean, pattern, F.lit(f"{MARK}$0{group}{MARK}")), MARK, -1)
    none = F.array().cast(f"array<{SPAN}>")
    zero = F.lit(0).cast("bigint")

    def step(state: Column, piece: Column) -> Column:
        value = F.element_at(F.split(piece, FIELD, -1), 1) if part else piece
        kept = F.element_at(F.split(piece, FIELD, -1), -1) if part else F.lit(None).cast("string")
        ends = state["at"] + F.length(value)
        span = F.struct(state["at"].alias("start"), ends.alias("end"), value.alias("value"), kept.alias("part"))
        return F.struct(
            ends.alias("at"),
            F.when(state["inside"], F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found"),
            (~state["inside"]).alias("inside"))

    def in_block(block: Column) -> Column:
        start = F.struct(zero.alias("at"), none.alias("found"), F.lit(False).alias("inside"))
        return F.aggregate(block, start, step, lambda s: F.struct(s["at"].alias("at"), s["found"].alias("found")))

    def over_blocks(state: Column, block: Column) -> Column:
        moved = F.transform(block["found"], lambda s: F.struct(
            (s["start"] + state["at"]).alias("start"), (s["end"] + state["at"]).alias("end"), s["value"].alias("value"), s["part"].alias("part")))
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["found"], moved).alias("found"))

    def found(all_pieces: Column) -> Column:
        # An even number of pieces per block: each begins outside of a match.
        width = F.greatest(F.lit(64), (F.ceil(F.sqrt(F.size(all_pieces)) / 2) * 2).cast("int"))
        last = F.floor((F.size(all_pieces) - 1) / width).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda i: in_block(F.slice(all_pieces, i * width + 1, width)))
        start = F.struct(zero.alias("at"), none.alias("found"))
        return F.aggregate(blocks, start, over_blocks, lambda s: s["found"])

    return F.when(F.rlike(text, pattern), _let(pieces, found)).otherwise(none)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: Column, kind: str, order: int) -> Column:
    """Spans as (start, order, kind, end), which sort by place and then by kind."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def masked(text: Column, spans: Column, mask) -> Column:
    """The text with each span replaced by ``mask(span)``; of spans that overlap the first one counts
    and the others lengthen the hole. ``spans`` are sorted by start."""
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        fresh = span["start"] >= done["at"]
        kept = F.substring(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(done["out"], kept, mask(span))).otherwise(done["out"]).alias("out"))

    return F.aggregate(spans, state, step, lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.lit(2147483647))))
