"""Benchmark decontamination by q-gram lemma filtering (operator 7).

Benchmark items are cut into overlapping windows, and each window may be met with a budget of
edits k. By the q-gram lemma a text region within k edits of a window of m characters shares at
least m - q + 1 - k q of its q-grams with it, all on diagonals that lie within k of each other.
So shared q-grams are counted per window in overlapping bands of diagonals, bands that reach the
bound are regions, and a region counts once a banded alignment finds at most k edits.

Windows have the length of the shortest passage that counts, and the next one starts no further
on than the budget of edits: a passage of that length anywhere in an item lacks fewer characters
of some window than the budget allows. The index holds the q-grams of an item once; the windows
that cover a place follow from it.

The benchmark is a stated query set. It travels in blocks of bounded size; the documents stay
where they are and are read once per block, whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import counted_side, free_name

Q = 8
#: Edits allowed per character of a window, and the length of windows: the shortest passage that counts.
EDIT_RATE, WINDOW = 0.08, 80
#: Characters of the benchmark that tasks get at a time.
BLOCK_CHARS = 4 << 20
#: Characters of documents that are hashed at a time.
STRETCH = 1 << 18
FILTER_BITS = 22

_ODD = np.uint64(0x9E3779B97F4A7C15)
_EDGE = 0x110000  # stands between texts; no character has this number


def _lower_table() -> np.ndarray:
    """Lower case of single characters, and any white space as a blank."""
    table = np.arange(_EDGE + 1, dtype=np.uint32)
    for code in range(0x250):
        low = chr(code).lower()
        if len(low) == 1:
            table[code] = ord(low)
        if chr(code).isspace():
            table[code] = 0x20
    return table


_LOWER = _lower_table()


def code_points(text: str) -> np.ndarray:
    return _LOWER[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]


def _qgrams(codes: np.ndarray) -> np.ndarray:
    """A hash of the Q = 8 characters from each place on."""
    h = codes.astype(np.uint64)
    for step, odd in ((1, 0x100000001B3), (2, 0xC2B2AE3D27D4EB4F), (4, 0x165667B19E3779F9)):
        h = h[:-step] + h[step:] * np.uint64(odd)
        h ^= h >> np.uint64(31)
    return h * _ODD


def budget(m: int) -> int:
    """Edits allowed for a window of ``m`` characters: the rate, while one shared q-gram is left."""
    return max(0, min(int(EDIT_RATE * m), (m - Q) // Q))


def bound(m: int) -> int:
    return m - Q + 1 - budget(m) * Q


#: From one window to the next: a passage of ``WINDOW`` characters lacks at most half of it.
STRIDE = budget(WINDOW)


class WindowIndex:
    """q-grams of the windows of some benchmark items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items: list[tuple[int, np.ndarray]] = []  # item_id, characters
        grams, place, low, high, begins = [], [], [], [], []
        first = 0
        for item, text in items:
            codes = code_points(text)
            if len(codes) < Q:
                continue
            last = max(0, len(codes) - WINDOW)
            starts = np.array(sorted({*range(0, last, STRIDE), last}))
            self.items.append((item, codes))
            begins.append(starts)
            at = np.arange(len(codes) - Q + 1)
            grams.append(_qgrams(codes))
            place.append(at)
            low.append(first + np.searchsorted(starts, at - (min(WINDOW, len(codes)) - Q)))
            high.append(first + np.searchsorted(starts, at, "right"))
            first += len(starts)
        flat, place, low, high = (np.concatenate(x) if x else np.zeros(0, kind) for x, kind in ((grams, np.uint64), (place, np.int64), (low, np.int64), (high, np.int64)))
        # Per window its item and its place and length there.
        self.owner = np.repeat(np.arange(len(begins)), [len(x) for x in begins])
        self.start = np.concatenate([*begins, np.zeros(0, np.int64)])
        order = np.argsort(flat, kind="stable")
        self.grams, first = np.unique(flat[order], return_index=True)
        self.first = np.append(first, len(flat))
        self.place, self.low, self.high = place[order], low[order], high[order]  # windows low to high - 1 hold the q-gram
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        self.m = np.minimum(np.array([len(c) for _, c in self.items], np.int64), WINDOW)[self.owner]
        self.k = np.array([budget(m) for m in range(WINDOW + 1)], np.int64)[self.m]
        self.bound = self.m - Q + 1 - self.k * Q
        # Any region holds a stretch of the shortest region's length with so many shared q-grams.
        self.span = int((self.m + self.k).min(initial=1 << 30))
        self.dense = int((-(-self.bound // -(-(self.m + self.k) // self.span))).min()) if len(self.m) else 1

    @classmethod
    def of(cls, state: dict) -> WindowIndex:
        """An index from its broadcast state: plain data, which tasks read without this class."""
        index = cls.__new__(cls)
        index.__dict__.update(state)
        return index

    def regions(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(window, lowest, highest diagonal) of the bands of joined texts that reach the bound."""
        if not len(self.grams) or len(codes) < Q:
            return []
        hashed = _qgrams(codes)
        hit = np.flatnonzero(self.filter[(hashed >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        at = np.searchsorted(self.grams, hashed[hit])
        real = self.grams[np.minimum(at, len(self.grams) - 1)] == hashed[hit]
        hit, at = hit[real], at[real]
        if not len(hit):
            return []
        # Keep hits that stand in some stretch with enough of them.
        ahead = np.searchsorted(hit, hit + self.span) - np.arange(len(hit))
        full = np.flatnonzero(ahead >= self.dense)
        cover = np.bincount(full, minlength=len(hit) + 1) - np.bincount(full + ahead[full], minlength=len(hit) + 1)
        near = np.cumsum(cover[:-1]) > 0
        hit, at = hit[near], at[near]
        n = self.first[at + 1] - self.first[at]
        entry = np.repeat(self.first[at] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        held = self.high[entry] - self.low[entry]
        window = np.repeat(self.low[entry] - np.cumsum(held) + held, held) + np.arange(int(held.sum()))
        diagonal = np.repeat(np.repeat(hit, n) - self.place[entry], held) + self.start[window]
        # Band b covers 2 (k + 1) diagonals from b (k + 1) on, so any k + 1 in a row lie in one.
        width = self.k[window] + 1
        band = np.floor_divide(diagonal, width)
        window, band, diagonal = np.concatenate([window, window]), np.concatenate([band, band - 1]), np.concatenate([diagonal, diagonal])
        order = np.lexsort((band, window))
        window, band, diagonal = window[order], band[order], diagonal[order]
        if not len(window):
            return []
        start = np.flatnonzero(np.append(True, (window[1:] != window[:-1]) | (band[1:] != band[:-1])))
        shared = np.diff(np.append(start, len(window)))
        low, high = np.minimum.reduceat(diagonal, start), np.maximum.reduceat(diagonal, start)
        good = shared >= self.bound[window[start]]
        return list(zip(window[start][good].tolist(), low[good].tolist(), high[good].tolist()))

    def window(self, window: int) -> tuple[int, int, np.ndarray]:
        """Item, place in it and characters of a window."""
        item, codes = self.items[self.owner[window]]
        at = int(self.start[window])
        return item, at, codes[at:at + WINDOW]

    def verify(self, codes: np.ndarray, window: int, low: int, high: int) -> tuple[int, int, int] | None:
        """(start, end, edits) in ``codes`` of the best alignment of a window near its diagonals, if within budget."""
        _, _, pattern = self.window(window)
        k, m = int(self.k[window]), len(pattern)
        for diagonal in dict.fromkeys((low, high)):
            if diagonal >= 0 and np.array_equal(codes[diagonal:diagonal + m], pattern):
                return diagonal, diagonal + m, 0
        return banded(pattern, codes, low - k, high + k, k)


def banded(pattern: np.ndarray, codes: np.ndarray, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """Best alignment of the whole pattern with any part of ``codes`` on diagonals low to high, within k edits."""
    width = high - low + 1
    far = k + len(pattern) + 1
    steps = np.arange(width)
    inside = lambda i: (i + low + steps >= 0) & (i + low + steps <= len(codes))
    cost = np.where(inside(0), 0, far)  # cell d of row i: pattern[:i] against codes ending before i + low + d
    origin = low + steps
    for i, char in enumerate(pattern, 1):
        ends = i + low + steps
        valid = inside(i)
        seen = codes[np.clip(ends - 1, 0, len(codes) - 1)]
        step = cost + np.where((ends >= 1) & (seen == char), 0, 1)
        skip, skip_from = np.append(cost[1:], far) + 1, np.append(origin[1:], 0)
        better = skip < step
        step, source = np.where(better, skip, step), np.where(better, skip_from, origin)
        step = np.where(valid, step, far)
        # Extra characters of the text: a running minimum along the row.
        level = step - steps
        best = np.minimum.accumulate(level)
        leader = np.maximum.accumulate(np.where(level == best, steps, 0))
        cost, origin = np.where(valid, best + steps, far), source[leader]
        if cost.min() > k:
            return None
    at = int(cost.argmin())
    return (int(max(0, origin[at])), len(pattern) + low + at, int(cost[at])) if cost[at] <= k else None


def _search(index, documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = WindowIndex.of(index.value)
        for batch in batches:
            ids = batch.column("doc_id")
            found: list[tuple] = []
            held, owners, size = [], [], 0
            for k in range(batch.num_rows):
                codes = code_points(batch.column("text")[k].as_py())
                held.append(codes)
                owners.append(k)
                size += len(codes)
                if size >= STRETCH or k == batch.num_rows - 1:
                    found += _found(windows, held, owners)
                    held, owners, size = [], [], 0
            if found:
                rows = list(zip(*found))
                yield pa.record_batch([ids.take(pa.array(rows[0])), *(pa.array(list(c), pa.int64()) for c in rows[1:])], ["doc_id", "item_id", "doc_start", "doc_end", "item_start", "item_end", "edits"])

    return documents.mapInArrow(run, "doc_id long, item_id long, doc_start long, doc_end long, item_start long, item_end long, edits long")


def _found(index: WindowIndex, held: list[np.ndarray], owners: list[int]) -> list[tuple]:
    """Verified regions of some texts: owner, item, interval of the text, interval of the item, edits."""
    edge = np.full(Q, _EDGE, np.uint32)
    joined = np.concatenate([x for codes in held for x in (codes, edge)])
    starts = np.cumsum([0, *(len(c) + Q for c in held)])[:-1]
    out = set()
    for window, low, high in index.regions(joined):
        # The middle of the region tells the text it lies in.
        k = max(0, int(np.searchsorted(starts, (low + high) // 2 + int(index.m[window]) // 2, "right")) - 1)
        got = index.verify(held[k], window, int(low - starts[k]), int(high - starts[k]))
        if got:
            item, place, pattern = index.window(window)
            out.add((owners[k], item, got[0], got[1], place, place + len(pattern), got[2]))
    return sorted(out)


def contaminated_regions(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Regions of documents within the edit budget of a window of a benchmark item.

    Columns: doc_id, item_id, doc_start, doc_end, item_start, item_end (characters), edits. One
    row per region and window; clean documents have none. Null texts are empty. An item of fewer
    than Q characters holds no q-gram and is never met; rows without item_id or text are no items.
    Repeated rows of either table each count, but equal rows of the result appear once per
    document row. Empty tables give no rows.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = max(1, -(-int(items.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS))
    out = None
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text")
        index = WindowIndex([tuple(r) for r in mine.collect()])
        one = _search(spark.sparkContext.broadcast(vars(index)), docs)
        out = one if out is None else out.unionByName(one)
    return out


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document and item: regions, characters of the item met, least edits."""
    regions = contaminated_regions(documents, benchmark)
    return regions.groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_windows"), F.min("doc_start").alias("doc_start"), F.max("doc_end").alias("doc_end"),
        F.min("item_start").alias("item_start"), F.max("item_end").alias("item_end"), F.min("edits").alias("edits"))


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that hold a region of the benchmark; all columns stay. What a text
    holds does not depend on its id, so rows are told by their texts: null and repeated ids too."""
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    texts = documents.select(key.alias("doc_id"), "text")
    name = free_name(documents, "_dirty")
    dirty = counted_side(contaminated_regions(texts, benchmark).select(F.col("doc_id").alias(name)).distinct())
    return documents.join(dirty, key == F.col(name), "left_anti")
