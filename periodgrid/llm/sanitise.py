"""Information-theoretic sanitisation of personal data (operator 4). SQL functions only.

Protected entities are e-mail addresses, IP addresses, payment cards and phone numbers, found by
pattern. What stands around an entity may still reveal it. Over all lines of the corpus it is
counted how often a term shares a line with an entity, repeated lines and rows included. The
pointwise mutual information log2(p(e | t) / p(e)), measured against the information of the entity
itself, log2(1 / p(e)), is the share of the entity that the term discloses. p(e | t) is smoothed
towards p(e), (n(t, e) + PRIOR p(e)) / (n(t) + PRIOR), so that it holds for entities and terms seen
once as well: no count is too small to be rated. In documents that hold the entity, terms above the upper threshold are removed and terms above the lower one generalised to
their shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored
from .spans import listed, masked, matches, of_kind

# Patterns of the base. Possessive forms match the same texts without going back.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A text without thirteen digits that stand together has no card.
CARD_GATE = r"(?:[0-9][\x20-]?){13}"
KINDS = ("email", "ip", "card", "phone")

#: Lines that the smoothing counts as, and the disclosed shares from which a term is generalised
#: and removed.
PRIOR, GENERALISE, REMOVE = 1.0, 0.8, 0.95
TERM = r"[\p{L}\p{N}_]{3,}+"
_BETWEEN = r"[^\p{L}\p{N}_]+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the check sum: every second digit from the right is doubled."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))) % 10 == 0


def entities(text: Column) -> dict[str, Column]:
    """Per kind the matches that hold, as arrays of (start, end, value, part)."""

    def octets(span: Column) -> Column:
        bare = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(span["value"], r"\."), lambda p: (F.length(bare(p)) <= 3) & (F.coalesce(F.when(F.length(bare(p)) <= 3, bare(p).try_cast("int")), F.lit(0)) <= 255))

    held = F.when(F.rlike(text, F.lit(CARD_GATE)), text).otherwise("")
    card = F.filter(matches(held, CARD), lambda s: F.length(_digits(s["value"])).between(13, 19) & _luhn(_digits(s["value"])))
    return {
        "email": matches(text, EMAIL),
        "ip": F.filter(matches(text, IP), octets),
        "card": card,
        "phone": F.filter(matches(text, PHONE), lambda s: F.length(_digits(s["value"])).between(9, 15)),
    }


def _names(found: dict[str, Column]) -> Column:
    """The distinct protected entities as kind=value, without case or punctuation."""
    plain = {"email": F.lower, "ip": lambda v: v, "card": _digits, "phone": _digits}

    def named(kind: str) -> Column:
        return F.transform(found[kind], lambda s: F.concat(F.lit(f"{kind}="), plain[kind](s["value"])))

    return F.array_distinct(F.concat(*map(named, KINDS)))


def _terms(line: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(line), _BETWEEN), lambda w: F.length(w) >= 3))


def _with_entities(documents: DataFrame) -> DataFrame:
    """doc_id, text and the base spans by kind of every document."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return docs.withColumns({f"_{k}": v for k, v in entities(F.col("text")).items()})


def _row_key() -> Column:
    return F.sha2(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text")), 256)


def disclosing_terms(documents: DataFrame, protected: DataFrame | None = None) -> DataFrame:
    """(entity, term, share) of the terms that disclose at least ``GENERALISE`` of an entity."""
    docs = documents.select(F.coalesce("text", F.lit("")).alias("text"))
    if protected is None:
        protected = _protected(_with_entities(documents))
    # Lines that hold an entity; no pattern reaches over a line end.
    lines = protected.select("rows", F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.withColumn("found", F.struct(*[spans.alias(k) for k, spans in entities(F.col("line")).items()]))
    found = {k: F.col(f"found.{k}") for k in KINDS}
    lines = lines.withColumn("names", _names(found)).where(F.size("names") > 0)
    # Only what is an entity is blanked: other numbers are terms like any word.
    spans = F.sort_array(F.concat(*[of_kind(found[k], k, i) for i, k in enumerate(KINDS)]))
    bare = masked(F.col("line"), spans, lambda _: F.lit(" "))
    held = stored(lines.select("rows", F.explode("names").alias("entity"), _terms(bare).alias("terms")))
    by_entity = held.groupBy("entity").agg(F.sum("rows").alias("n_e"))
    joint = stored(held.select("rows", "entity", F.explode("terms").alias("term")).groupBy("entity", "term").agg(F.sum("rows").alias("n_te")))
    # Every line counts once for each of its terms, and once for the empty term: that is N.
    seen = docs.select(F.explode(F.flatten(F.transform(F.split("text", "\n"), lambda line: F.concat(F.array(F.lit("")), _terms(line))))).alias("term"))
    counts = seen.groupBy("term").agg(F.count("*").alias("n_t"))
    wanted = joint.select("term").distinct().unionByName(joint.sparkSession.range(1).select(F.lit("").alias("term")))
    counts = stored(counts.join(wanted, "term", "left_semi"))
    total = counts.where("term = ''").select(F.col("n_t").alias("n"))
    rated = joint.join(by_entity, "entity").join(counts, "term").crossJoin(F.broadcast(total))  # one row
    base = F.col("n_e") / F.col("n")
    share = F.log2((F.col("n_te") + PRIOR * base) / (F.col("n_t") + PRIOR) / base) / -F.log2(base)
    return rated.where("n > n_e").select("entity", "term", share.alias("share")).where(F.col("share") >= GENERALISE)


def _protected(found: DataFrame) -> DataFrame:
    """The documents that hold an entity, under a key of the row, and how many rows are alike."""
    names = _names({k: F.col(f"_{k}") for k in KINDS})
    held = found.where(" or ".join(f"size(_{k}) > 0" for k in KINDS))
    alike = held.select(_row_key().alias("key"), "text", names.alias("names")).groupBy("key")
    return alike.agg(F.first("text").alias("text"), F.first("names").alias("names"), F.count("*").alias("rows"))


def _term_spans(protected: DataFrame, terms: DataFrame) -> DataFrame:
    """Per row key the places of its disclosing terms: removed or generalised."""
    # By the terms a document holds: an entity of many documents may have terms in each of them.
    holds = protected.select("key", F.explode(_terms(F.col("text"))).alias("term")).join(terms, "term")
    wanted = holds.join(protected.select("key", F.explode("names").alias("entity")), ["key", "entity"], "left_semi")
    by_row = wanted.groupBy("key", "term").agg(F.max("share").alias("share")).groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("shares"))
    placed = protected.select("key", "text").join(by_row, "key")
    # Words in the line order, with what their term discloses; those within an entity are covered already.
    # Only the spellings that stand for a term are looked for: time grows with the text, not its square.
    spelt = F.filter(F.array_distinct(F.regexp_extract_all("text", F.lit(TERM), F.lit(0))), lambda w: F.try_element_at("shares", F.lower(w)).isNotNull())
    placed = placed.withColumn("_spelt", F.array_join(spelt, "|"))
    edge = r"[\p{L}\p{N}_]"
    pattern = F.when(F.col("_spelt") == "", "(?!)").otherwise(F.concat(F.lit(f"(?<!{edge})(?:"), "_spelt", F.lit(f")(?!{edge})")))
    words = F.transform(matches(F.col("text"), pattern), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.try_element_at("shares", F.lower(s["value"])).alias("share")))
    kinds = {"remove": lambda w: w["share"] >= REMOVE, "generalise": lambda w: w["share"] < REMOVE}
    both = [of_kind(F.filter("_words", holds), kind, len(KINDS) + k) for k, (kind, holds) in enumerate(kinds.items())]
    return placed.withColumn("_words", F.filter(words, lambda w: w["share"].isNotNull())).select("key", F.concat(*both).alias("_terms"))


def _found(documents: DataFrame) -> DataFrame:
    """Every document with its base spans (by kind, then place) and its term spans."""
    base = _with_entities(documents)
    protected = stored(_protected(base))
    terms = stored(disclosing_terms(documents, protected))
    extra = stored(_term_spans(protected, terms))
    spans = F.concat(*[of_kind(F.col(f"_{k}"), k, i) for i, k in enumerate(KINDS)])
    sized = [F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    key = F.when(F.size("_base") > 0, _row_key())  # only rows with an entity meet terms
    each = base.select("doc_id", "text", *sized, spans.alias("_base")).withColumn("key", key)
    return each.join(extra, "key", "left")


def find_personal_data(documents: DataFrame) -> DataFrame:
    """Per document its personal data and the terms that disclose it, as places in the whole text.

    Output: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms. Places are in
    characters, ends exclusive. A null or empty text has none. Repeated rows and null ids give
    one row each; every row is a context of its own. Other columns are not read. No rows give
    no rows.
    """
    found = _found(documents)
    none = F.slice("_base", 1, 0)
    spans = F.concat("_base", F.coalesce("_terms", none))
    return found.select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2(listed(F.col("_base")), 256).alias("base_sha256"),
        listed(spans).alias("spans"), F.coalesce(F.size("_terms"), F.lit(0)).alias("n_terms"))


def sanitised(documents: DataFrame) -> DataFrame:
    """doc_id and the text with entities named by kind, terms removed or reduced to their shape."""
    found = _found(documents)
    spans = F.sort_array(F.concat("_base", F.coalesce("_terms", F.slice("_base", 1, 0))))

    def mask(span: Column) -> Column:
        word = F.substring(F.col("text"), (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int"))
        shape = F.regexp_replace(F.regexp_replace(word, r"\p{L}", "x"), r"\p{N}", "0")
        named = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        return F.when(span["kind"] == "remove", F.lit("")).when(span["kind"] == "generalise", shape).otherwise(named)

    return found.select("doc_id", masked(F.col("text"), spans, mask).alias("text"))
