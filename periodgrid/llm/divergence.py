"""Source divergence audit: how the words of a source differ from its language's and other sources'.

Documents are first cut at ASCII white space only. Each task counts its chunks per (lang, source);
the counts of one chunk meet in one place, where the chunk is taken apart into terms once, however
many documents hold it. Its terms inherit the counts and meet again per term.

A term is kept if it stands in ``MIN_DOCS`` documents of its language. Distinct documents are
counted by their ids: of each chunk (then of each term) the ``MIN_DOCS`` smallest ids go along,
which is enough to tell "fewer" from "as many or more" exactly, whatever meets whatever.

Defined cases: a null text, lang or source is ''. Each row is a document, also if rows or ids
repeat or ids are null; other columns are not read. A group without terms has count 0 for each
kept term; a language without kept terms gives value 0 to each pair. No rows, no result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import slices, stored, table

MIN_DOCS = 3
TERM_RANKS = 200
UNIT = 10 ** 9
#: What a term is not made of: ASCII but for letters.
_GAP = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text whose chunks meet in one part, and counted rows or bytes a task holds at most.
PART_BYTES = 8 << 20
HELD_ROWS = 1 << 18
HELD_BYTES = 32 << 20
_PACKED = "part int, counts binary, ids binary"
_KEPT = "lang string, term string, sources array<string>, counts array<long>"


# -- tables inside a task ---------------------------------------------------------------------

def _pack(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _codes(column) -> tuple[np.ndarray, pa.Array]:
    """Per row the place of its value in the distinct values, and those."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _first_ids(lang: np.ndarray, word: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places of the ``MIN_DOCS`` smallest distinct ids of each (lang, word)."""
    order = np.lexsort((ids, word, lang))
    lang, word, ids = lang[order], word[order], ids[order]
    same = np.zeros(len(order), bool)
    same[1:] = (lang[1:] == lang[:-1]) & (word[1:] == word[:-1])
    fresh = ~same
    fresh[1:] |= ids[1:] != ids[:-1]
    order, same = order[fresh], same[fresh]
    starts = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    return order[np.arange(len(order)) - starts < MIN_DOCS]


def _merged(counts: list[pa.Table], ids: list[pa.Table], word: str) -> tuple[pa.Table, pa.Table]:
    """Counts added up per (lang, source, word) and the smallest ids per (lang, word)."""
    total = pa.concat_tables(counts).group_by(["lang", "source", word]).aggregate([("n", "sum")]).rename_columns(["lang", "source", word, "n"])
    every = pa.concat_tables(ids)
    kept = _first_ids(_codes(every["lang"])[0], _codes(every[word])[0], every["id"].to_numpy())
    return total, every.take(pa.array(kept))


def _dealt(counts: pa.Table, ids: pa.Table, word: str, parts: int) -> Iterator[pa.RecordBatch]:
    """One row per part with what belongs there: all of a word goes to the part of its hash."""
    codes, words = _codes(counts[word])
    part_of = np.array([xxhash.xxh3_64_intdigest(w) % parts for w in words.to_pylist()], np.int64)
    alphabetic = np.empty(len(words), np.int64)
    alphabetic[pc.sort_indices(words).to_numpy()] = np.arange(len(words))

    def sorted_parts(rows: pa.Table, place: np.ndarray) -> tuple[pa.Table, np.ndarray]:
        order = np.lexsort((alphabetic[place], part_of[place]))
        return rows.take(pa.array(order)).combine_chunks(), np.searchsorted(part_of[place][order], np.arange(parts + 1))

    id_place = pc.index_in(ids[word].combine_chunks(), words).to_numpy(zero_copy_only=False).astype(np.int64)
    counts, at = sorted_parts(counts, codes)
    ids, id_at = sorted_parts(ids, id_place)
    for k in np.flatnonzero(np.diff(at)).tolist():
        packed = [_pack(counts.slice(at[k], at[k + 1] - at[k])), _pack(ids.slice(id_at[k], id_at[k + 1] - id_at[k]))]
        yield pa.record_batch([pa.array([k], pa.int32()), *(pa.array([p], pa.binary()) for p in packed)], ["part", "counts", "ids"])
    pa.default_memory_pool().release_unused()


def _gathered(batches: Iterator[pa.RecordBatch], word: str) -> tuple[pa.Table, pa.Table]:
    """All packed rows of a part, merged as they come."""
    counts, ids, fresh = [], [], 0
    for batch in batches:
        for c, i in zip(batch.column("counts").to_pylist(), batch.column("ids").to_pylist()):
            counts.append(_unpack(c))
            ids.append(_unpack(i))
            fresh += len(counts[-1])
            if fresh > HELD_ROWS:
                merged = _merged(counts, ids, word)
                counts, ids, fresh = [merged[0]], [merged[1]], 0
    return _merged(counts, ids, word)


def chunk_counts(texts: pa.Array, langs: pa.Array, sources: pa.Array, first_id: int) -> tuple[pa.Table, pa.Table]:
    """``lang, source, chunk, n`` and ``lang, chunk, id`` of some documents, numbered from ``first_id``."""
    chunks = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    sizes = pc.list_value_length(chunks).to_numpy(zero_copy_only=False)
    flat, row = chunks.flatten(), np.repeat(np.arange(len(sizes)), sizes)
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    word, words = _codes(flat.filter(pa.array(real)))
    row = row[real]
    (lang, lang_names), (source, source_names) = _codes(langs), _codes(sources)
    key = (lang[row] * len(source_names) + source[row]) * max(len(words), 1) + word
    keys, n = np.unique(key, return_counts=True)
    group, at = np.divmod(keys, max(len(words), 1))
    l, s = np.divmod(group, max(len(source_names), 1))
    counts = pa.table([lang_names.take(pa.array(l)), source_names.take(pa.array(s)), words.take(pa.array(at)), pa.array(n, pa.int64())], ["lang", "source", "chunk", "n"])
    kept = _first_ids(lang[row], word, row)
    ids = pa.table([lang_names.take(pa.array(lang[row][kept])), words.take(pa.array(word[kept])), pa.array(row[kept] + first_id, pa.int64())], ["lang", "chunk", "id"])
    return counts, ids


def chunk_terms(chunks: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Of lower-cased chunks: the place of the chunk, the term, and how often it stands there."""
    words = pc.ascii_split_whitespace(pc.replace_substring_regex(chunks, _GAP, " "))
    owner = np.repeat(np.arange(len(chunks)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    flat = words.flatten()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    term, terms = _codes(flat.filter(pa.array(real)))
    keys, times = np.unique(owner[real] * max(len(terms), 1) + term, return_counts=True)
    owner, term = np.divmod(keys, max(len(terms), 1))
    return owner, terms.take(pa.array(term)), times


def to_terms(counts: pa.Table, ids: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Counts and ids of chunks as those of their terms; each distinct chunk is looked at once."""
    place, chunks = _codes(counts["chunk"])
    owner, terms, times = chunk_terms(chunks)
    at = np.searchsorted(owner, np.arange(len(chunks) + 1))
    width = np.diff(at)

    def spread(rows: pa.Table, place: np.ndarray) -> tuple[pa.Table, np.ndarray]:
        """A row per row and term of its chunk, and the place of that term."""
        back = np.repeat(np.arange(len(place)), width[place])
        n = width[place]
        entry = np.arange(len(back)) - np.repeat(np.cumsum(n) - n, n) + at[place][back]
        return rows.take(pa.array(back)).drop_columns(["chunk"]).append_column("term", terms.take(pa.array(entry))), entry

    id_place = pc.index_in(ids["chunk"].combine_chunks(), chunks).to_numpy(zero_copy_only=False).astype(np.int64)
    counted, entry = spread(counts, place)
    n = counted["n"].to_numpy() * times[entry]
    counted = counted.drop_columns(["n"]).append_column("n", pa.array(n, pa.int64())).select(["lang", "source", "term", "n"])
    return _merged([counted], [spread(ids, id_place)[0].select(["lang", "term", "id"])], "term")


def kept_terms(counts: pa.Table, ids: pa.Table) -> pa.RecordBatch:
    """A row per (lang, term) with enough documents: its sources and its count in each."""
    docs = ids.group_by(["lang", "term"]).aggregate([("id", "count")])
    docs = docs.filter(pc.greater_equal(docs["id_count"], MIN_DOCS)).select(["lang", "term"])
    rows = counts.join(docs, ["lang", "term"], join_type="inner").sort_by([("lang", "ascending"), ("term", "ascending"), ("source", "ascending")]).combine_chunks()
    lang, term = _codes(rows["lang"])[0], _codes(rows["term"])[0]
    new = np.flatnonzero(np.r_[True, (lang[1:] != lang[:-1]) | (term[1:] != term[:-1])]) if len(rows) else np.zeros(0, np.int64)
    ends = pa.array(np.append(new, len(rows)), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, rows[name].combine_chunks()) for name in ("source", "n")]
    firsts = [rows[name].take(pa.array(new)).combine_chunks() for name in ("lang", "term")]
    return pa.record_batch([*firsts, *lists], ["lang", "term", "sources", "counts"])


# -- the corpus -------------------------------------------------------------------------------

def vocabulary(docs: DataFrame) -> DataFrame:
    """``lang, term, sources, counts`` of all kept terms of ``docs(text, lang, source)``, stored."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / PART_BYTES))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, ids, rows, held, number = [], [], 0, 0, TaskContext.get().partitionId() << 40
        for batch in batches:
            done = 0
            for texts in slices(batch.column("text")):
                own = slice(done, done + len(texts))
                found = chunk_counts(texts, batch.column("lang")[own], batch.column("source")[own], number)
                done, number = done + len(texts), number + len(texts)
                counts.append(found[0])
                ids.append(found[1])
                rows += len(found[0])
                held += found[0].nbytes + found[1].nbytes
            if rows > HELD_ROWS or held > HELD_BYTES:
                yield from _dealt(*_merged(counts, ids, "chunk"), "chunk", parts)
                counts, ids, rows, held = [], [], 0, 0
        if rows:
            yield from _dealt(*_merged(counts, ids, "chunk"), "chunk", parts)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _dealt(*to_terms(*_gathered(batches, "chunk")), "term", parts)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield kept_terms(*_gathered(batches, "term"))

    chunks = docs.select("text", "lang", "source").mapInArrow(count, _PACKED)
    terms = chunks.groupBy("part").applyInArrow(tokenise, _PACKED)
    return stored(terms.groupBy("part").applyInArrow(keep, _KEPT))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """p of a count, in whole numbers of any size."""
    return 1 + F.call_function("div", (count.cast("decimal(20,0)") + 1) * F.lit(UNIT).cast("decimal(10,0)"), (total + kept).cast("decimal(20,0)"))


def shares(counts: np.ndarray, total, kept: int) -> np.ndarray:
    """p of counts as above, in two steps that stay within 64 bits up to 9 * 10^14 occurrences."""
    base = np.asarray(total, np.int64) + kept
    high, rest = np.divmod((counts + 1) * 10 ** 4, base)
    return 1 + high * 10 ** 5 + rest * 10 ** 5 // base


def pair_sums(kept: DataFrame, groups: dict[str, tuple[list[str], np.ndarray, int]]) -> DataFrame:
    """``lang, source, item, value``: the sum over all kept terms for each two sources of a lang.

    The groups (their sources, totals and the number of kept terms) travel to every task: the
    result has a row for each two of them, so their list is small beside it.
    """
    shared = kept.sparkSession.sparkContext.broadcast(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {lang: np.zeros((len(g[0]),) * 2, np.int64) for lang, g in shared.value.items()}
        for batch in batches:
            lang, names = _codes(batch.column("lang"))
            for k, name in enumerate(names.to_pylist()):
                sources, totals, number = shared.value[name]
                rows = batch.filter(pa.array(lang == k))
                step = max(1, (1 << 20) // len(sources))
                for at in range(0, rows.num_rows, step):
                    piece = rows.slice(at, step)
                    held = piece.column("sources")
                    row = np.repeat(np.arange(piece.num_rows), pc.list_value_length(held).to_numpy(zero_copy_only=False))
                    column = pc.index_in(held.flatten(), pa.array(sources, pa.string())).to_numpy(zero_copy_only=False)
                    counts = np.zeros((piece.num_rows, len(sources)), np.int64)
                    counts[row, column] = piece.column("counts").flatten().to_numpy(zero_copy_only=False)
                    p = np.ascontiguousarray(shares(counts, totals, number).T)
                    for g in range(len(sources)):
                        sums[name][g] += ((p[g] - p) ** 2 // p).sum(axis=1)
        for name, matrix in sums.items():
            sources = shared.value[name][0]
            g, h = (m.ravel() for m in np.indices(matrix.shape))
            some = (g != h) & (matrix.ravel() > 0)
            names = pa.array(sources, pa.string())
            yield pa.record_batch(
                [pa.array([name] * int(some.sum()), pa.string()), names.take(pa.array(g[some])), names.take(pa.array(h[some])), pa.array(matrix.ravel()[some], pa.int64())],
                ["lang", "source", "item", "value"])

    added = kept.mapInArrow(run, "lang string, source string, item string, value long")
    return added.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence_audit(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank`` (see the module) for ``docs(text, lang, source)``."""
    docs = docs.select(*[F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("text", "lang", "source")])
    groups = stored(docs.select("lang", "source").distinct())
    kept = vocabulary(docs)
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)).alias("whole"))
    entries = kept.select("lang", "term", "counts", F.explode(F.arrays_zip("sources", "counts")).alias("_e"))
    entries = entries.select("lang", "term", "counts", F.col("_e.sources").alias("source"), F.col("_e.counts").alias("n"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = stored(
        groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
        .select("lang", "source", *[F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name) for name in ("total", "v", "whole")]))

    listed: dict[str, tuple[list[str], np.ndarray, int]] = {}
    for lang, rows in known.toPandas().groupby("lang"):
        rows = rows.sort_values("source")
        listed[lang] = rows["source"].tolist(), rows["total"].to_numpy(np.int64), int(rows["v"].iloc[0])
    other = groups.withColumnRenamed("source", "item")
    pairs = groups.join(other, "lang").where("source <> item")
    valued = pairs.join(pair_sums(kept, listed), ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce(F.col("value"), F.lit(0).cast("long")).alias("value"))

    p = _share(F.col("n"), F.col("total"), F.col("v"))
    q = _share(F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n), F.col("whole"), F.col("v"))
    shared = entries.join(known, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), q.alias("q")).where("p > q")
    terms = shared.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = terms.withColumn("rank", rank).where(F.col("rank") <= TERM_RANKS)
    return valued.withColumn("rank", rank).unionByName(ranked)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit(table(spark, sf_dir, "documents"))


DIVERGENCE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}
), v AS (
  SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT g.lang, g.source, k.term, count(w.r) AS c FROM g JOIN k ON k.lang = g.lang
  LEFT JOIN w ON w.lang = g.lang AND w.source = g.source AND w.term = k.term GROUP BY ALL
), n AS (
  SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL
), p AS (
  SELECT c.lang, c.source, c.term, c.c, 1 + (1000000000 * (c.c + 1)::HUGEINT) // (n.n + v.v)::HUGEINT AS p
  FROM c JOIN n ON n.lang = c.lang AND n.source = c.source JOIN v ON v.lang = c.lang
), q AS (
  SELECT k.lang, k.term, 1 + (1000000000 * (k.c + 1)::HUGEINT) // (v.n + v.v)::HUGEINT AS q FROM k JOIN v ON v.lang = k.lang
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, ((p - q) * (p - q) // q)::BIGINT FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TERM_RANKS}
"""
