"""N-gram Jaccard self-join by vertical partitioning (operator 10).

All n-grams get one global order: rare ones by hash, then those that very many documents hold.
The order is cut into fragments. A fragment holds the stretch of each document's n-grams that
falls in it, and counts the partial overlaps of the documents that meet there; partial counts
are summed per pair. It takes two passes:

* Candidate pass: only the prefix of each document (a - ceil(0.8 a) + 1 n-grams of a; a linked
  pair must meet there) is dealt to the fragments. The summed partial overlap and the places of
  the last shared n-gram bound the whole overlap from above; pairs below the need are gone.
* Counting pass: the whole sets of the documents that are left are cut into fragments, each
  counts its part of the overlap, and the sums decide exactly.

Texts with equal sets are one class and travel once. An n-gram of very many documents is last in
the order, so it stands in the prefix only of documents made of such n-grams, that is in large
groups of near copies. These are not paired with each other: every document meets one pivot per
n-gram, links make components, and only pairs across different components meet later.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import components, counted_side, parts_of, stored
from .shingles import set_key, shingle_sets

#: Share of the intersection in the union from which two documents link, in percent.
PERCENT = 80
#: Bits of the hash by which n-grams are counted for the order.
COUNT_BITS = 30
#: An n-gram with at most so many occurrences is never frequent.
RARE = 64
#: Entries of the list of frequent n-grams that tasks get: 8 bytes each, so 8 MiB at most. The
#: list shapes the order, and any order gives the same links.
FREQUENT = 1 << 20
#: Rows a task holds before it hands them on.
CHUNK = 1 << 20
#: Pairs a task holds before it hands them on; they cost more than n-grams, and Spark adds them up.
PAIRED = 1 << 18
#: Parts of a document's set in the counting pass.
CUTS = 2
#: Pivots of a frequent n-gram in each round: few for the many that link to any, more for the rest.
PIVOTS = (4, 24, 48)

#: Overlap that a pair needs, and whether its first shared n-gram comes early enough for it: each
#: set must still hold that many n-grams from there on.
NEED = "ceil({p}D * (n_{a} + n_{b}) / {q}D - 1e-9)"
EARLY = "first_{a} + " + NEED + " <= n_{a} and first_{b} + " + NEED + " <= n_{b}"


def early(a: str, b: str):
    return F.expr(EARLY.format(a=a, b=b, p=PERCENT, q=100 + PERCENT))


def needed(n: int) -> int:
    """The least overlap of a set of ``n`` with any set it links to."""
    return -(-PERCENT * n // 100)


def prefix_length(n: int) -> int:
    return n - needed(n) + 1


def enough(overlap, a, b):
    """100 i >= PERCENT u for an overlap i of sets of a and b, without the union."""
    return (100 + PERCENT) * overlap >= PERCENT * (a + b)


# -- the order ----------------------------------------------------------------------------

def _planes(numbers: np.ndarray) -> bytes:
    """Rising numbers as byte planes of their differences, which compress well."""
    steps = np.diff(numbers, prepend=numbers[:1] * 0).astype("<u4")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(steps.astype(np.int64))


def frequent_ngrams(texts: DataFrame) -> np.ndarray:
    """Hash buckets (``COUNT_BITS`` bits) of the n-grams with the most documents, sorted.

    Each task counts what it has read; the counts of all tasks meet per range of buckets. The
    list holds every bucket with more than max(RARE, h) documents, where h is the least power of
    two that keeps it within ``FREQUENT`` entries.
    """
    ranges, shift = 4 * parts_of(texts.sparkSession), np.uint64(64 - COUNT_BITS)

    def flush(kept: list[np.ndarray]) -> pa.RecordBatch:
        buckets = np.concatenate(kept)
        kept.clear()
        buckets.sort()
        start = np.append(np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])), len(buckets)).astype(np.uint32)
        buckets, counts = buckets[start[:-1]], np.diff(start)
        cut = np.searchsorted(buckets, np.array([(k << COUNT_BITS) // ranges for k in range(ranges + 1)], np.uint32))
        rows = [(k, _planes(buckets[a:b]), counts[a:b]) for k, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
        packed = [np.ascontiguousarray(c.view(np.uint8).reshape(-1, 4).T).tobytes() for _, _, c in rows]
        return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array(packed, pa.binary())], ["part", "buckets", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for grams in shingle_sets(batch.column(0)):
                kept.append((grams >> shift).astype(np.uint32))
                held += len(grams)
                if held >= 2 * CHUNK:
                    yield flush(kept)
                    held = 0
        if held:
            yield flush(kept)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            pieces = [total]
            for buckets, counts in zip(batch.column("buckets").to_pylist(), batch.column("counts").to_pylist()):
                numbers = np.ascontiguousarray(np.frombuffer(counts, np.uint8).reshape(4, -1).T).view("<u4").ravel()
                pieces.append((_numbers(buckets), numbers.astype(np.int64)))
            keys, place = np.unique(np.concatenate([p[0] for p in pieces]), return_inverse=True)
            total = keys, np.bincount(place, np.concatenate([p[1] for p in pieces]), len(keys)).astype(np.int64)
        often = total[1] > RARE
        yield pa.record_batch([pa.array(total[0][often]), pa.array(total[1][often])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(count, "part int, buckets binary, counts binary")
    often = stored(counted.groupBy("part").applyInArrow(add, "bucket long, n long"))
    sizes = often.groupBy(F.floor(F.log2("n")).alias("power")).count().orderBy(F.desc("power")).collect()
    power, room = 63, FREQUENT
    for row in sizes:
        room -= row["count"]
        if room < 0:
            break
        power = row["power"]
    listed = often.where(F.col("n") >= F.lit(2) ** power).select("bucket").toArrow().column(0).to_numpy()
    return np.sort(listed)


def in_order(grams: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, int]:
    """The set by the global order, and how many of its n-grams are not frequent."""
    if not len(frequent):
        return grams, len(grams)
    buckets = (grams >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
    hot = frequent[np.minimum(np.searchsorted(frequent, buckets), len(frequent) - 1)] == buckets
    return np.concatenate([grams[~hot], grams[hot]]), len(grams) - int(hot.sum())


# -- candidate pass -----------------------------------------------------------------------

def _sizes_and_hot(docs: DataFrame, frequent) -> DataFrame:
    """Per document its set's size and class, and the frequent n-grams in its prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hot, places, sizes, keys = [], [], [], []
            for grams in shingle_sets(batch.column("text")):
                sizes.append(len(grams))
                keys.append(set_key(grams) if len(grams) else None)
                ordered, rare = in_order(grams, frequent.value)
                hot.append(ordered[rare:prefix_length(len(grams))].view(np.int64).copy())
                places.append(rare)
            ends = np.cumsum([0, *map(len, hot)])
            flat = np.concatenate(hot) if hot else np.zeros(0, np.int64)
            yield pa.record_batch([
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(places, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64())),
            ], ["doc_id", "n", "cls", "rare", "hot"])

    return docs.mapInArrow(run, "doc_id long, n long, cls binary, rare long, hot array<long>")


def _fragments(docs: DataFrame, frequent, fragments: int) -> DataFrame:
    """The rare part of the prefixes, packed per fragment of the order: n-gram, document, place.

    A document is told by the first half of its class key, its size, the length of the rare part
    and the upper bits of the n-gram at which its prefix ends (all ones: no rare n-gram follows).
    """
    # Prefixes stand at the low end of the order, so most cuts lie in its first quarter.
    low = max(1, fragments * 7 // 8)
    cuts = [(k << 62) // low for k in range(low)] + [(1 << 62) + (k * (3 << 62)) // max(1, fragments - low) for k in range(fragments - low)]
    cuts = np.array(cuts, np.uint64)

    def flush(grams: list, owners: list) -> pa.RecordBatch:
        gram = np.concatenate(grams)
        order = np.argsort(gram)
        gram = gram[order]
        told = np.array(owners, OWNER)
        owner = np.repeat(np.arange(len(told)), told["rare"])[order]
        place = np.concatenate([np.arange(n) for n in told["rare"]])[order]
        cut = np.append(np.searchsorted(gram, cuts), len(gram))
        rows = []
        for k, (a, b) in enumerate(zip(cut, cut[1:])):
            if b > a:
                own, local = np.unique(owner[a:b], return_inverse=True)
                rows.append((k, gram[a:b].tobytes(), local.astype("<u4").tobytes(), place[a:b].astype("<u4").tobytes(), told[own].tobytes()))
        kinds = [pa.int32()] + [pa.binary()] * 4
        return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], ["part", "grams", "owners", "places", "told"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, owners, seen, rows = [], [], set(), 0
        for batch in batches:
            for grams in shingle_sets(batch.column("text")):
                if not len(grams) or (key := set_key(grams)) in seen:
                    continue
                seen.add(key)
                ordered, rare = in_order(grams, frequent.value)
                n = min(rare, prefix_length(len(grams)))
                if n:
                    ends = int(ordered[n - 1] >> np.uint64(48)) if n < rare else 0xFFFF
                    kept.append(ordered[:n].copy())
                    owners.append((key[:8], len(grams), n, ends))
                    rows += n
                if rows >= CHUNK:
                    yield flush(kept, owners)
                    kept, owners, seen, rows = [], [], set(), 0
        if rows:
            yield flush(kept, owners)

    return docs.select("text").mapInArrow(run, "part int, grams binary, owners binary, places binary, told binary")


#: What a fragment knows of a document.
OWNER = np.dtype([("key", "V8"), ("n", "<u4"), ("rare", "<u4"), ("ends", "<u2")])

PAIRS = "a binary, b binary, n_a long, n_b long, rest long, shared long, first_a long, first_b long"


def _partial_overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One fragment: how many n-grams each pair of classes shares in it, and the last places."""
    grams, owners, places, told = [], [], [], []
    for batch in batches:
        for row in zip(*(batch.column(c) for c in ("grams", "owners", "places", "told"))):
            for column, cell, kind in zip((grams, owners, places, told), row, (np.uint64, "<u4", "<u4", OWNER)):
                column.append(np.frombuffer(cell.as_buffer(), kind))
    bases = np.cumsum([0, *map(len, told)])
    told = np.concatenate(told)
    # One document as it is told: equal sets are told alike.
    known, first, same = np.unique(told.view(f"V{OWNER.itemsize}"), return_index=True, return_inverse=True)
    told = told[first]
    key, size, rare, cut = told["key"], told["n"].astype(np.int64), told["rare"].astype(np.int64), told["ends"]
    same = same.ravel().astype(np.uint32)
    # Column by column, so that few of them are there twice.
    gram = np.concatenate(grams)
    owner = np.concatenate([same[base:][o] for base, o in zip(bases, owners)])
    place = np.concatenate(places)
    del grams, owners, places, batch
    order = np.lexsort((owner, gram))
    gram = gram[order]
    owner = owner[order]
    place = place[order]
    del order
    once = np.ones(len(gram), bool)  # a class read by several tasks came several times
    once[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    gram, owner, place = gram[once], owner[once], place[once]
    shared = np.zeros(len(gram), bool)
    shared[1:] = gram[1:] == gram[:-1]
    shared[:-1] |= shared[1:]
    gram, owner, place = gram[shared], owner[shared].astype(np.int64), place[shared].astype(np.int64)
    found, held = [], 0

    def flush(found: list) -> pa.RecordBatch:
        code, pa_, pb_ = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(code, kind="stable")
        code, pa_, pb_ = code[order], pa_[order], pb_[order]
        start = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        a, b = code[start] >> 32, code[start] & 0xFFFFFFFF
        counts = np.diff(np.append(start, len(code)))
        # Up to where the shorter reaching prefix ends all shared n-grams are counted; of what
        # that document holds beyond, all may be shared.
        beyond = size - rare
        rest = np.where(cut[a] == cut[b], np.maximum(beyond[a], beyond[b]), np.where(cut[a] < cut[b], beyond[a], beyond[b]))
        numbers = (size[a], size[b], rest, counts, np.minimum.reduceat(pa_, start), np.minimum.reduceat(pb_, start))
        cells = [pa.FixedSizeBinaryArray.from_buffers(pa.binary(8), len(x), [None, pa.py_buffer(key[x].tobytes())]).cast(pa.binary()) for x in (a, b)]
        return pa.record_batch(cells + [pa.array(x.astype(np.int64)) for x in numbers], ["a", "b", "n_a", "n_b", "rest", "shared", "first_a", "first_b"])

    # Whole runs of one n-gram in stretches, so that memory stays bounded for any list lengths.
    starts = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])) if len(gram) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(gram))
    stretch = np.append(0, np.cumsum((ends - starts) * (ends - starts - 1) // 2))
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(stretch, stretch[at] + PAIRED, "right")) - 1)
        lo, hi = starts[at], ends[to - 1]
        g, o, p = gram[lo:hi], owner[lo:hi], place[lo:hi]
        for k in range(1, int((ends[at:to] - starts[at:to]).max())):
            i = np.flatnonzero(g[k:] == g[:-k])
            a, b = o[i], o[i + k]
            fits = 100 * np.minimum(size[a], size[b]) >= PERCENT * np.maximum(size[a], size[b])
            i, a, b = i[fits], a[fits], b[fits]
            if len(i):
                found.append(((a << 32) | b, p[i], p[i + k]))
                held += len(i)
        if held >= PAIRED:
            yield flush(found)
            found, held = [], 0
        at = to
    if held:
        yield flush(found)


def _rare_candidates(docs: DataFrame, classes: DataFrame, frequent, fragments: int) -> DataFrame:
    """Pairs that may reach the threshold by what they share in the rare part of their prefixes."""
    dealt = _fragments(docs, frequent, fragments)
    partial = dealt.groupBy("part").applyInArrow(_partial_overlaps, PAIRS)
    summed = partial.groupBy("a", "b").agg(
        *[F.first(c).alias(c) for c in ("n_a", "n_b", "rest")], F.sum("shared").alias("shared"),
        F.min("first_a").alias("first_a"), F.min("first_b").alias("first_b"))
    near = stored(summed.where(enough(F.col("shared") + F.col("rest"), F.col("n_a"), F.col("n_b")) & early("a", "b")).select("a", "b"))
    # Should two classes share half a key, both are candidates; the count decides.
    short = [classes.select(F.substring("cls", 1, 8).alias(side), F.col("cls").alias(f"cls_{side}"), F.col("n").alias(f"n_{side}")) for side in "ab"]
    full = near.join(short[0], "a").join(short[1], "b").where("cls_a <> cls_b")
    rising = F.col("cls_a") < F.col("cls_b")
    return full.select(
        F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b"),
        F.when(rising, F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
        F.when(rising, F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"))


# -- counting pass ------------------------------------------------------------------------

def _cut_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The sets of ``classes(cls, doc_id)``, cut into ``CUTS`` ranges of the order."""
    cuts = np.array([(k << 64) // CUTS for k in range(1, CUTS)], np.uint64)

    def flush(keys: list[bytes], pieces: list[bytes]) -> pa.RecordBatch:
        parts = np.tile(np.arange(CUTS, dtype=np.int32), len(keys) // CUTS)
        return pa.record_batch([pa.array(keys, pa.binary()), pa.array(parts), pa.array(pieces, pa.binary())], ["cls", "part", "grams"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, pieces, held = [], [], 0
            for grams in shingle_sets(batch.column(0)):
                if not len(grams):
                    continue
                keys += [set_key(grams)] * CUTS
                pieces += [x.tobytes() for x in np.split(grams, np.searchsorted(grams, cuts))]
                held += len(grams)
                if held >= CHUNK:
                    yield flush(keys, pieces)
                    keys, pieces, held = [], [], 0
            if held:
                yield flush(keys, pieces)

    chosen = docs.join(counted_side(classes.select("doc_id")), "doc_id", "left_semi").select("text")
    return chosen.mapInArrow(run, "cls binary, part int, grams binary").dropDuplicates(["cls", "part"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared = []
        for one, two in zip(batch.column("one"), batch.column("two")):
            x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
            x, y = (x, y) if len(x) <= len(y) else (y, x)
            place = np.searchsorted(y, x)
            shared.append(int((y[np.minimum(place, len(y) - 1)] == x).sum()) if len(x) else 0)
        yield pa.record_batch([*(batch.column(c) for c in ("a", "b", "n_a", "n_b")), pa.array(shared, pa.int64())], ["a", "b", "n_a", "n_b", "shared"])


def _links(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose partial overlaps, summed over all fragments, reach the threshold."""
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    sets = stored(_cut_sets(docs, classes.join(wanted, "cls", "left_semi")))
    each = pairs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(CUTS - 1))))
    with_a = each.join(sets.select(F.col("cls").alias("a"), "part", F.col("grams").alias("one")), ["a", "part"])
    both = with_a.join(sets.select(F.col("cls").alias("b"), "part", F.col("grams").alias("two")), ["b", "part"])
    parts = both.select("a", "b", "n_a", "n_b", "one", "two").mapInArrow(_count, "a binary, b binary, n_a long, n_b long, shared long")
    whole = parts.groupBy("a", "b", "n_a", "n_b").agg(F.sum("shared").alias("shared"))
    return stored(whole.where(enough(F.col("shared"), F.col("n_a"), F.col("n_b"))).select("a", "b"))


def _merged(links: DataFrame) -> DataFrame:
    return components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))).withColumnRenamed("id", "cls")


# -- frequent n-grams ---------------------------------------------------------------------

#: Columns of a frequent n-gram's document, and their names in a pair.
SIDE = (("cls", "cls"), ("n", "n"), ("place", "first"))
PIVOT = "struct<draw: bigint, comp: binary, cls: binary, n: bigint, place: bigint>"


def _dense_links(docs: DataFrame, classes: DataFrame, prefixes: DataFrame, links: DataFrame, tried: DataFrame) -> DataFrame:
    """Links that only documents made of frequent n-grams have: pivots first, then what is left.

    A pair within one component adds nothing to the components, so it is not tried. Pivots only
    save work: every pair across the components they leave is counted at the end.
    """
    hot = prefixes.select("cls", "n", "rare", F.posexplode("hot").alias("place", "gram"))
    hot = stored(hot.withColumn("place", F.col("rare") + F.col("place")))
    for turn in range(len(PIVOTS) + 1):
        merged = _merged(links)
        owned = stored(hot.join(merged, "cls", "left").withColumn("comp", F.coalesce("component", "cls")).select("gram", "cls", "n", "place", "comp"))
        seeds = range(sum(PIVOTS[:turn]), sum(PIVOTS[:turn + 1]) or 1)
        drawn = [F.min(F.struct(F.xxhash64("cls", F.lit(k)).alias("draw"), "comp", "cls", "n", "place")) for k in seeds] or [F.lit(None).cast(PIVOT)]
        spread = stored(owned.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.array_distinct(F.array(*drawn)).alias("pivots")).where("low <> high"))
        if spread.isEmpty():
            return links
        if turn == len(PIVOTS):
            break
        star = owned.join(spread.select("gram", F.explode("pivots").alias("pivot")), "gram").where("comp <> pivot.comp")
        star = star.select(
            *[F.col(c).alias(f"{as_}_x") for c, as_ in SIDE], *[F.col(f"pivot.{c}").alias(f"{as_}_y") for c, as_ in SIDE])
        star = _new_pairs(star.where(early("x", "y")), tried)
        tried = stored(tried.unionByName(star.select("a", "b")))
        links = stored(links.unionByName(_links(docs, classes, star)))
    # Across the components that are left, each pair at the first frequent n-gram both prefixes hold.
    left = owned.join(spread.select("gram"), "gram", "left_semi")
    sided = [left.join(prefixes.select("cls", "hot"), "cls").select("gram", *[F.col(c).alias(f"{as_}_{side}") for c, as_ in (*SIDE, ("comp", "comp"), ("hot", "hot"))]) for side in "xy"]
    first = F.element_at(F.array_intersect("hot_x", "hot_y"), 1)
    across = sided[0].join(sided[1], "gram").where((F.col("comp_x") < F.col("comp_y")) & early("x", "y") & (F.col("gram") == first))
    rest = _new_pairs(across, tried)
    return stored(links.unionByName(_links(docs, classes, rest)))


def _new_pairs(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    """Distinct (a, b) with a < b that were not tried before."""
    rising = F.col("cls_x") < F.col("cls_y")
    ordered = pairs.select(
        F.least("cls_x", "cls_y").alias("a"), F.greatest("cls_x", "cls_y").alias("b"),
        F.when(rising, F.col("n_x")).otherwise(F.col("n_y")).alias("n_a"),
        F.when(rising, F.col("n_y")).otherwise(F.col("n_x")).alias("n_b")).distinct()
    return stored(ordered.join(tried, ["a", "b"], "left_anti"))


def jaccard_components(documents: DataFrame) -> DataFrame:
    """Per document its number of shingles and its near-duplicate group.

    Input: ``doc_id``, ``text``; other columns are not read. Output: ``doc_id``, ``n_shingles``,
    ``component_id`` (the smallest doc_id reachable by links, itself included).

    A null, empty or blank text has no shingles, links with nothing and is its own group. A text
    of fewer than five words is one shingle. Equal sets link. A row without a doc_id links with
    nothing and gets a null group. Repeated rows give one result each and share a group; rows
    that repeat a doc_id with another text are linked by their texts. No rows give no rows.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_ngrams(docs))
    each = stored(_sizes_and_hot(docs, frequent))
    linkable = each.where("cls is not null and doc_id is not null")
    classes = stored(linkable.groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")))
    pairs = stored(_rare_candidates(docs, classes, frequent, max(4, parts_of(spark) // 2)))
    links = _links(docs, classes, pairs)
    prefixes = stored(linkable.where(F.size("hot") > 0).select("cls", "n", "rare", "hot").distinct())
    links = _dense_links(docs, classes, prefixes, links, pairs.select("a", "b"))
    merged = classes.join(_merged(links), "cls", "left")
    root = F.coalesce("component", "cls")
    lowest = merged.groupBy(root.alias("component")).agg(F.min("doc_id").alias("component_id"))
    by_class = stored(merged.withColumn("component", root).join(lowest, "component").select("cls", "component_id"))
    found = each.join(by_class, "cls", "left")
    alone = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))
