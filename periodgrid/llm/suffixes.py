"""Repeated strings by a distributed difference-cover algorithm.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a
smaller id. Suffixes need to be told apart up to that depth only:

1. *Sample and name.* A position is sampled if its remainder modulo ``PERIOD`` is in ``COVER``; as
   ``COVER`` is a difference cover, any two positions are, at some common distance below
   ``PERIOD``, both sampled. So two equal strings of 50 bytes hold at one distance two sampled
   triples (three characters of 10 bytes). Equal triples get one name.
2. *Recurse on names.* A sampled position is named once more by its triple together with what a
   window around it can reach. Positions with equal second names are equal in every window, so
   all windows of those with a larger id are settled at once.
3. *Merge the remaining suffixes.* Where one name has several second names, the windows that hold
   the triple are sorted by their 50 bytes, and equal neighbours are compared by id.

Names are prints of the bytes (88 bits, and those that choose the part): parts are the buckets of
the sort. Before all that, text that cannot repeat is left out: of each window the least of its
24-byte grams is an anchor, and a window whose anchor stands in one text only is unique.

Equal whole texts are one string with their smallest id; the others go whole. A name that many
positions share is reduced in each task to its smallest id before it is shuffled.

Defined cases: null text is empty; a null id counts as larger than all others (and as equal to
2^63 - 1), rows with one id do not remove each other's bytes; a text below 50 bytes stays whole.
Other columns are not read. No rows, no result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import fits_broadcast
from ..session import delete_path
from .common import counted_side, parts_of, stored, table, whole_text

LENGTH = 50
PERIOD, CHARACTER = 21, 10
#: A perfect difference set modulo 21.
COVER = (0, 1, 4, 14, 16)
TRIPLE = 3 * CHARACTER
REACH = LENGTH - TRIPLE
GRAM = 24
SPAN = LENGTH - GRAM + 1
LAST_ID = (1 << 63) - 1
#: Bytes hashed at once (a longer text is cut with an overlap; their prints fit a core's cache), rows a
#: task holds, rows of a part.
CUT = 1 << 16
HELD = 1 << 19
PART_ROWS = 1 << 19
#: Bytes of shared stretches that leave a task at once.
CELL_BYTES = 4 << 20
#: Stored bytes of the removed runs up to which they go to the texts, rather than texts to them.
SPAN_BYTES = 8 << 20
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of a print that go along within a part. Two anchors that share them by chance keep a stretch
#: in; strings are told apart by name and second name together.
ANCHOR_BYTES, NAME_BYTES, SECOND_BYTES = 4, 5, 6
_BOXES = "part int, settled boolean, n int, names binary, seconds binary, places binary, ids binary"
_ANSWERS = ("settled_from", "settled_to", "asked_from", "asked_to")
_BOX_NAMES = ["part", "settled", "n", "names", "seconds", "places", "ids"]


# -- prints of substrings ---------------------------------------------------------------------

class Prints:
    """64-bit prints of any substring of up to ``CUT`` bytes, from running sums of a polynomial."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.letters = rng.integers(0, 1 << 64, 256, np.uint64)
        base = int(rng.integers(1 << 62, 1 << 63)) | 1
        self.powers, self.backs = (
            np.cumprod(np.append(np.uint64(1), np.full(CUT, b, np.uint64))) for b in (base, pow(base, -1, 1 << 64)))

    def read(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.powers[:len(data)], out=self.sums[1:])

    def of(self, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[ends] - self.sums[at]) * self.backs[at])

    def all(self, width: int) -> np.ndarray:
        """The print of the ``width`` bytes from every place on."""
        n = max(len(self.sums) - width, 0)
        return _mixed((self.sums[width:] - self.sums[:n]) * self.backs[:n])


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _slide(x: np.ndarray, width: int, least_or_most) -> np.ndarray:
    """The least or most of every ``width`` neighbours, by doubling."""
    done = 1
    while 2 * done <= width:
        x, done = least_or_most(x[:-done], x[done:]), 2 * done
    return least_or_most(x[:done - width], x[width - done:]) if done < width else x


def groups(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches of at most ``CUT`` bytes: ``(data, starts, ends, owner, begin)``. Pieces (from
    ``starts`` to ``ends`` in ``data``) are whole texts of 50 bytes or more, or cuts of a longer one
    that overlap by 49 bytes, so that each window is in just one; ``begin`` is where in the text."""
    wide = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, wide)[column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    sizes, step = np.diff(offsets), CUT - LENGTH + 1
    long = np.flatnonzero(sizes >= LENGTH)
    cuts = 1 + np.maximum(-(-(sizes[long] - CUT) // step), 0)
    owner = np.repeat(long, cuts)
    begin = (np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * step
    starts = offsets[owner] + begin
    ends = np.minimum(starts + CUT, offsets[owner + 1])
    at = 0
    while at < len(owner):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + CUT, "right")))
        own = slice(at, to)
        yield data[starts[at]:ends[to - 1]], starts[own] - starts[at], ends[own] - starts[at], owner[own], begin[own]
        at = to


def _least_grams(prints: Prints, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prints of all grams, and of each window the least of them (0: no window starts here)."""
    grams = prints.all(GRAM) | np.uint64(1)
    least = _slide(grams, SPAN, np.minimum).copy()
    # Between the last window of a piece and the next piece none starts.
    last = ends - LENGTH + 1
    least[_ranges(last, np.minimum(np.append(starts[1:], len(least)), len(least)) - last)] = 0
    return grams, least


def anchors(prints: Prints, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and prints of the grams that are the least of some window."""
    grams, least = _least_grams(prints, starts, ends)
    rim = np.zeros(SPAN - 1, np.uint64)
    at = np.flatnonzero(_slide(np.concatenate([rim, least, rim]), SPAN, np.maximum) == grams)
    return at, grams[at]


def shared_windows(prints: Prints, starts: np.ndarray, ends: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Per place: does a window start there whose least gram is among the ``shared`` places?"""
    grams, least = _least_grams(prints, starts, ends)
    known = np.full(len(grams), np.uint64((1 << 64) - 1))
    known[shared] = grams[shared]
    return (_slide(known, SPAN, np.minimum) == least) & (least > 0)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The whole numbers of all ranges, in order; a range of no or less than no size has none."""
    size = np.maximum(size, 0)
    return np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of true flags."""
    edges = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


# -- rows on their way to a part --------------------------------------------------------------

# Of a box alone, as operator 3 sends them.

def _squeezed(*numbers: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes."""
    planes = b"".join(np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for x in numbers)
    return pa.Codec("zstd").compress(planes, asbytes=True)


def _spread(data: bytes, n: int, columns: int) -> list[np.ndarray]:
    planes = pa.Codec("zstd").decompress(data, decompressed_size=8 * n * columns, asbytes=True)
    planes = np.frombuffer(planes, np.uint8).reshape(columns, 8, n)
    return [np.ascontiguousarray(p.T).view("<i8").ravel() for p in planes]


def _places(text: np.ndarray, at: np.ndarray) -> bytes:
    """Sorted places as differences."""
    new = np.r_[True, text[1:] != text[:-1]]
    return _squeezed(np.diff(text, prepend=0), np.where(new, at, np.diff(at, prepend=0)))


def _unplaces(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    steps, at = _spread(data, n, 2)
    text = np.cumsum(steps)
    total = np.cumsum(at)
    new = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    base = (total - at)[new]
    return text, total - np.repeat(base, np.diff(np.append(new, n)))


# A task deals the rows it holds to all parts at once: a record batch has a row (a box) for each part,
# and its columns are written and read as a whole. The number of boxes grows with the square of the
# input, so a box must cost no more than its row.

def _zigzag(x: np.ndarray) -> np.ndarray:
    return ((x << 1) ^ (x >> 63)).view(np.uint64)


def _unzigzag(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(1)).view(np.int64) ^ -(x & np.uint64(1)).view(np.int64)


def _steps(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Differences of neighbours; at the ``first`` rows of boxes the number itself."""
    steps = np.diff(x, prepend=0)
    steps[first] = x[first]
    return steps


def _summed(steps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The numbers of such differences."""
    total = np.cumsum(steps)
    return total - np.repeat((total - steps)[first], np.diff(np.append(first, len(steps))))


def _new_texts(steps: np.ndarray, first: np.ndarray) -> np.ndarray:
    new = steps != 0
    new[first] = True
    return np.flatnonzero(new)


def _places_of_boxes(text: np.ndarray, at: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts and places as differences in varints, the bytes of each box, and the rows that begin a text."""
    steps = _steps(text, first)
    new = _new_texts(steps, first)
    data, width = _varints(_zigzag(np.stack([steps, _steps(at, new)], 1).ravel()))
    return data, np.add.reduceat(width, 2 * first), new


def _unplaces_of_boxes(data: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts and places of boxes of ``n`` rows, the first row of each box, and the rows that begin a text."""
    numbers = _unzigzag(_from_varints(data)[0].view(np.uint64))
    first, steps = np.cumsum(n) - n, numbers[::2]
    new = _new_texts(steps, first)
    return _summed(steps, first), _summed(numbers[1::2], new), first, new


def _low_bytes(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _from_low_bytes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _varints(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers in bytes of seven bits, and how many bytes each takes."""
    numbers = numbers.view(np.uint64)
    most = max(-(-int(numbers.max(initial=0)).bit_length() // 7), 1)
    width = np.ones(len(numbers), np.int64)
    for k in range(1, most):
        width += numbers >= np.uint64(1 << (7 * k))
    at = np.cumsum(width) - width
    out, wide = np.zeros(int(width.sum()), np.uint8), width
    for k in range(most):
        if k:
            longer = wide > k
            numbers, wide, at = numbers[longer], wide[longer], at[longer]
        out[at + k] = ((numbers >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | ((wide > k + 1).astype(np.uint8) << 7)
    return out, width


def _from_varints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers, and the place of the byte that ends each."""
    ends = np.flatnonzero(data < 128)
    starts = np.append(0, ends[:-1] + 1)[:len(ends)]
    numbers = (data[starts] & 127).astype(np.int64)
    some, k = np.flatnonzero(ends > starts), 1
    while len(some):
        numbers[some] |= (data[starts[some] + k] & 127).astype(np.int64) << (7 * k)
        k += 1
        some = some[starts[some] + k <= ends[some]]
    return numbers, ends


def _boxes(part: np.ndarray, parts: int, settled: bool, text: np.ndarray, at: np.ndarray, names=None, width: int = 0, second=None, ids=None) -> Iterator[pa.RecordBatch]:
    """Rows dealt to their parts, in the order they come in; without second names and ids for the
    anchors, without names for the way back. An id is told once for a text."""
    if not len(text):
        return
    order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
    part, text, at = part[order], text[order], at[order]
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    n = np.diff(np.append(first, len(part)))
    places, sizes, new = _places_of_boxes(text, at, first)
    told = pa.nulls(len(n), pa.binary())
    if ids is not None:
        box = np.searchsorted(new, first)
        steps, widths = _varints(_zigzag(_steps(ids[order[new]], box)))
        told = _cut_bytes(steps, np.add.reduceat(widths, box))
    yield pa.record_batch(
        [pa.array(part[first], pa.int32()), pa.array(np.full(len(n), settled)), pa.array(n, pa.int32()),
         pa.nulls(len(n), pa.binary()) if names is None else _cut_bytes(_low_bytes(names[order], width), width * n),
         pa.nulls(len(n), pa.binary()) if second is None else _cut_bytes(_low_bytes(second[order], SECOND_BYTES), SECOND_BYTES * n),
         _cut_bytes(places, sizes), told], _BOX_NAMES)


def _settled_box(text: np.ndarray, at: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Places that need no comparison any more; they only pass through a part."""
    if len(text):
        yield from _boxes(np.full(len(text), int(text[0] % parts)), parts, True, text, at)


def _reply_boxes(text: np.ndarray, at: np.ndarray, parts: int, settled: bool = True) -> Iterator[pa.RecordBatch]:
    """Places on their way back to the part of their text; neighbouring texts share a part."""
    yield from _boxes(((text >> 33) * 31 + ((text & ((1 << 33) - 1)) >> 8)) % parts, parts, settled, text, at)


def _settled_replies(settled: list[tuple[np.ndarray, np.ndarray]], parts: int) -> Iterator[pa.RecordBatch]:
    """Replies to settled places, of about ``HELD`` together."""
    kept, held = [], 0
    for k, places in enumerate(settled, 1):
        kept.append(places)
        held += len(places[0])
        if held >= HELD or k == len(settled):
            yield from _reply_boxes(*(np.concatenate(c) for c in zip(*kept)), parts)
            kept, held = [], 0


def _by_text(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places by text and place. They are below 2^31, as ``begin`` and the lists of them are."""
    texts, which = np.unique(text, return_inverse=True)
    packed = which.astype(np.int64) << 32 | at
    packed.sort()
    return texts[packed >> 32], packed & 0xFFFFFFFF


def _replies(batches: Iterator[pa.RecordBatch]) -> dict[bool, tuple[np.ndarray, np.ndarray]]:
    """All places of a part by text and place: those of settled boxes and the others."""
    found: dict[bool, list] = {True: [], False: []}
    for settled, _, places in _read(batches):
        found[settled].append(places[:2])
    return {kind: _by_text(*(np.concatenate(c) for c in zip(*boxes))) if boxes else (np.zeros(0, np.int64),) * 2 for kind, boxes in found.items()}


def _open_boxes(name, second, text, at, ids, parts: int) -> Iterator[pa.RecordBatch]:
    """Rows dealt to the parts of their names; without second names and ids for the anchors."""
    part = ((name >> np.uint64(8 * NAME_BYTES)) % np.uint64(parts)).astype(np.int64)
    yield from _boxes(part, parts, False, text, at, name, ANCHOR_BYTES if second is None else NAME_BYTES, second, ids)


def _sent(batches: Iterator[pa.RecordBatch], rows_of: Callable, reduce: Callable, parts: int, *prints: "Prints") -> Iterator[pa.RecordBatch]:
    """Rows of all batches, reduced and dealt whenever ``HELD`` have come together."""
    kept, held = [], 0
    for batch in batches:
        for rows in rows_of(batch, *prints):
            kept.append(rows)
            held += len(rows[0])
            if held >= HELD:
                yield from reduce(*(np.concatenate(c) for c in zip(*kept)), parts)
                kept, held = [], 0
                pa.default_memory_pool().release_unused()
    if held:
        yield from reduce(*(np.concatenate(c) for c in zip(*kept)), parts)


def _bytes_of(column: pa.BinaryArray) -> np.ndarray:
    """The bytes of all rows, one after the other."""
    offsets, data = column.buffers()[1:]
    offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch, tuple]]:
    """Boxes of one kind with their texts and places."""
    for batch in batches:
        for settled in (True, False):
            own = batch.filter(batch.column("settled") if settled else pc.invert(batch.column("settled")))
            if own.num_rows:
                yield settled, own, _unplaces_of_boxes(_bytes_of(own.column("places")), own.column("n").to_numpy().astype(np.int64))


def _opened(batches: Iterator[pa.RecordBatch], full: bool) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
    """The rows of a part (name, text, at and, if ``full``, second name and id) and settled places."""
    columns, settled = [], []
    for known, boxes, (text, at, first, new) in _read(batches):
        if known:
            settled.append((text, at))
            continue
        rows = [_from_low_bytes(_bytes_of(boxes.column("names")), NAME_BYTES if full else ANCHOR_BYTES), text, at]
        if full:
            ids = _summed(_unzigzag(_from_varints(_bytes_of(boxes.column("ids")))[0].view(np.uint64)), np.searchsorted(new, first))
            rows += [_from_low_bytes(_bytes_of(boxes.column("seconds")), SECOND_BYTES), np.repeat(ids, np.diff(np.append(new, len(text))))]
        columns.append(rows)
    return [np.concatenate(c) for c in zip(*columns)], settled


def _in_order(name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by name, those of one name as they came, and where in that order a name begins."""
    order = np.argsort(name)  # fast, as it need not be stable
    ranked = name[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]][:len(name)]
    packed = np.cumsum(new) << 32 | order
    packed.sort()
    return packed & 0xFFFFFFFF, np.flatnonzero(new)


def _in_order_of_both(name: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for pairs of a name and a second name."""
    order, first = _in_order(_mixed(name ^ second * np.uint64(0x9E3779B97F4A7C15)))
    new = np.r_[True, (np.diff(name[order]) != 0) | (np.diff(second[order]) != 0)][:len(name)]
    if np.count_nonzero(new) != len(first):  # two pairs have one print
        order = np.lexsort((second, name))
        new = np.r_[True, (np.diff(name[order]) != 0) | (np.diff(second[order]) != 0)]
    return order, np.flatnonzero(new)


def _per_text(text: np.ndarray, *lists: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """Rows sorted by text as one row per text with a list per column."""
    new = np.flatnonzero(np.r_[True, text[1:] != text[:-1]]) if len(text) else np.zeros(0, np.int64)
    ends = pa.array(np.append(new, len(text)), pa.int32())
    return pa.record_batch(
        [pa.array(text[new], pa.int64()), *(pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in lists)], names)


# -- texts and their shared stretches ---------------------------------------------------------

def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, key, text``: equal texts have equal keys."""
    return docs.select("doc_id", F.unhex(F.md5(whole_text())).alias("key"), whole_text().alias("text"))


def copied_texts(docs: DataFrame) -> DataFrame:
    """``key, first``: texts that stand in several rows, with their smallest id; stored."""
    counted = keyed(docs).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    return counted_side(counted.where("n > 1").drop("n"))


def _texts(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """``t, key, id, text`` of the texts to compare, one row for all copies with a larger id; stored."""
    marked = copies.withColumn("copied", F.lit(True))
    first = F.when(F.col("copied"), F.col("first")).otherwise(F.col("doc_id"))
    found = keyed(docs).where(F.octet_length("text") >= LENGTH).join(marked, "key", "left").where(F.col("doc_id").eqNullSafe(first))
    return _stored(found.select(
        F.monotonically_increasing_id().alias("t"), "key", F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "text"))


def _stored(step: DataFrame) -> DataFrame:
    """A stored step whose shuffle files go as soon as it is written; else they stay until the driver
    happens to collect its garbage, and several steps of the size of the texts lie on disk at once."""
    conf, before = step.sparkSession.conf, step.sparkSession.conf.get(SHUFFLES_GO, None)
    conf.set(SHUFFLES_GO, "true")
    try:
        return stored(step)
    finally:
        if before is None:
            conf.unset(SHUFFLES_GO)
        else:
            conf.set(SHUFFLES_GO, before)


def discard(step: DataFrame) -> None:
    """Delete a stored step that nothing reads any more, to make room for the next ones."""
    for folder in {name.rsplit("/", 1)[0] for name in step.inputFiles()[:1]}:
        delete_path(step.sparkSession, folder)


def _parts(rows: float, spark: SparkSession) -> int:
    return max(parts_of(spark), math.ceil(rows / PART_ROWS))


def shared_anchors(texts: DataFrame) -> DataFrame:
    """``t, places``: the anchors of each text that stand in another text as well; stored."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = _parts(2 * size / (SPAN + 1), texts.sparkSession)

    def rows_of(batch: pa.RecordBatch, prints: Prints):
        number = batch.column("t").to_numpy()
        for data, starts, ends, owner, begin in groups(batch.column("text")):
            prints.read(data)
            at, names = anchors(prints, starts, ends)
            which = np.searchsorted(starts, at, "right") - 1
            yield names, number[owner[which]], at - starts[which] + begin[which]

    def in_several(name, text):
        """Rows by name, the first and last row of each name, whether several texts have it, and that per row."""
        order, new = _in_order(name)
        text = text[order]
        shared = np.minimum.reduceat(text, new) != np.maximum.reduceat(text, new)
        often = np.zeros(len(name), bool)
        often[order] = np.repeat(shared, np.diff(np.append(new, len(name))))
        return order, new, np.append(new[1:], len(name)) - 1, shared, often

    def reduce(name, text, at, parts):
        # A name that two texts of this task share is known to be shared: two rows tell the others.
        # The rows of a text come one after the other, so the first and the last one are of two texts.
        if not len(name):
            return
        order, new, last, shared, often = in_several(name, text)
        yield from _settled_box(text[often], at[often], parts)
        send = ~often
        send[order[new[shared]]] = send[order[last[shared]]] = True
        yield from _open_boxes(name[send], None, text[send], at[send], None, parts)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, settled = _opened(batches, False)
        if columns:
            name, text, at = columns
            often = in_several(name, text)[-1]
            settled.append((text[often], at[often]))
        yield from _settled_replies(settled, parts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, at = _replies(batches)[True]
        new = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
        steps, width = _varints(np.where(np.r_[True, text[1:] != text[:-1]], at, np.diff(at, prepend=0)))
        yield pa.record_batch([pa.array(text[new], pa.int64()), _cut_bytes(steps, np.add.reduceat(width, new))], ["t", "places"])

    boxes = texts.select("t", "text").mapInArrow(lambda batches: _sent(batches, rows_of, reduce, parts, Prints(1)), _BOXES)
    back = boxes.groupBy("part").applyInArrow(settle, _BOXES)
    return _stored(back.groupBy("part").applyInArrow(pack, "t long, places binary"))


def _cut_bytes(data: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    ends = pa.py_buffer(np.append(0, np.cumsum(sizes)).astype(np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, ends, pa.py_buffer(data)])


def _unpacked_places(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all rows, and where each row's begin."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    steps, ends = _from_varints(data)
    bounds = np.searchsorted(ends, offsets - offsets[0])
    places = np.cumsum(steps)
    before = np.append(0, places)[bounds[:-1]]
    return places - np.repeat(before, np.diff(bounds)), bounds


def stretches(texts: DataFrame) -> DataFrame:
    """``c, t, id, begin, data``: the runs of windows with shared anchors, a row each; stored."""
    # Both sides are dealt by text: the lists of places grow with the corpus.
    shared = shared_anchors(texts)

    def found(batch: pa.RecordBatch, prints: Prints):
        number, ids = batch.column("t").to_numpy(), batch.column("id").to_numpy()
        places, bounds = _unpacked_places(batch.column("places"))
        for data, starts, ends, owner, begin in groups(batch.column("text")):
            prints.read(data)
            sizes = bounds[owner + 1] - bounds[owner]
            piece = np.repeat(np.arange(len(owner)), sizes)
            at = places[_ranges(bounds[owner], sizes)] - begin[piece]
            own = (at >= 0) & (at + GRAM <= (ends - starts)[piece])
            first, last = runs(shared_windows(prints, starts, ends, (at + starts[piece])[own]))
            # Runs of neighbouring pieces are told apart by where a window may start.
            which = np.searchsorted(starts, first, "right") - 1
            cells = [data[a:b + LENGTH].tobytes() for a, b in zip(first.tolist(), last.tolist())]
            yield number[owner[which]], ids[owner[which]], first - starts[which] + begin[which], cells

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, kept, held = Prints(1), [], 0

        def sent():
            number, ids, begin = (np.concatenate(c) for c in [*zip(*kept)][:3])
            cells = pa.array([x for rows in kept for x in rows[3]], pa.binary())
            return pa.record_batch([pa.array(number, pa.int64()), pa.array(ids, pa.int64()), pa.array(begin, pa.int32()), cells], ["t", "id", "begin", "data"])

        for batch in batches:
            for rows in found(batch, prints):
                kept.append(rows)
                held += sum(map(len, rows[3]))
                if held >= CELL_BYTES:
                    yield sent()
                    kept, held = [], 0
        if kept:
            yield sent()

    cut = texts.select("t", "id", "text").join(shared.hint("merge"), "t").mapInArrow(run, "t long, id long, begin int, data binary")
    cut = _stored(cut.select(F.monotonically_increasing_id().alias("c"), "t", "id", "begin", "data"))
    discard(shared)
    return cut


# -- names ------------------------------------------------------------------------------------

def sampled(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all sampled triples of the pieces, and their pieces."""
    n = np.maximum(ends - starts - TRIPLE + 1, 0)
    cover = np.array(COVER)
    size = len(COVER) * (n // PERIOD) + np.searchsorted(cover, n % PERIOD)
    turn, place = np.divmod(_ranges(np.zeros(len(n), np.int64), size), len(COVER))
    return turn * PERIOD + cover[place], np.repeat(np.arange(len(starts)), size)


def _larger(name, second, ids) -> np.ndarray:
    """Per row: has its name with its second name a smaller id in another row?"""
    order, first = _in_order_of_both(name, second)
    ranked = ids[order]
    larger = np.zeros(len(name), bool)
    if len(name):
        larger[order] = ranked > np.repeat(np.minimum.reduceat(ranked, first), np.diff(np.append(first, len(name))))
    return larger


def _reduce_ids(name, second, text, at, ids, parts):
    """Of each second name only the smallest id of a task travels; all others are settled."""
    larger = _larger(name, second, ids)
    yield from _settled_box(text[larger], at[larger], parts)
    rest = ~larger
    yield from _open_boxes(name[rest], second[rest], text[rest], at[rest], ids[rest], parts)


def _compared(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Boxes of settled places, whose string a smaller id has, and of asked ones: their name stands
    with several second names of several ids, so that parts of their strings may be equal."""
    columns, settled = _opened(batches, True)
    if columns:
        name, text, at, second, ids = columns
        larger = _larger(name, second, ids)
        settled.append((text[larger], at[larger]))
        name, second, text, at, ids = (x[~larger] for x in (name, second, text, at, ids))
        order, new = _in_order(name)
        several = [np.minimum.reduceat(x[order], new) != np.maximum.reduceat(x[order], new) for x in (ids, second)]
        ask = np.zeros(len(name), bool)
        ask[order] = np.repeat(several[0] & several[1], np.diff(np.append(new, len(name))))
        yield from _reply_boxes(text[ask], at[ask], parts, False)
    yield from _settled_replies(settled, parts)


def _joined_runs(text: np.ndarray, at: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted places as runs whose neighbours are at most ``gap`` apart: text, first, last."""
    if not len(text):
        return text, at, at
    first = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (at[1:] - at[:-1] > gap)])
    return text[first], at[first], at[np.append(first[1:], len(at)) - 1]


def name_triples(cut: DataFrame, parts: int) -> DataFrame:
    """Steps 1 and 2: per stretch the runs of windows that are ``settled`` and of those ``asked``,
    as their first and last places; a run may reach beyond its stretch. Stored."""

    def rows_of(batch: pa.RecordBatch, prints: Prints, other: Prints):
        number, ids = batch.column("c").to_numpy(), batch.column("id").to_numpy()
        for data, starts, ends, owner, _ in groups(batch.column("data")):
            prints.read(data)
            other.read(data)
            at, piece = sampled(starts, ends)
            place = starts[piece] + at
            left, right = np.maximum(place - REACH, starts[piece]), np.minimum(place + LENGTH, ends[piece])
            # Where a stretch ends, the second name says how far it reaches.
            edge = ((place - left) * 64 + (right - place)).astype(np.uint64)
            second = _mixed(other.of(left, right) ^ (edge * np.uint64(0x9E3779B97F4A7C15)))
            yield prints.of(place, place + TRIPLE), second, number[owner[piece]], at, ids[owner[piece]]

    boxes = cut.select("c", "id", "data").mapInArrow(
        lambda batches: _sent(batches, rows_of, _reduce_ids, parts, Prints(2), Prints(3)), _BOXES)
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _compared(batches, parts)

    def join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _replies(batches)
        runs_of = [_joined_runs(*found[kind], REACH + 1) for kind in (True, False)]
        texts = np.unique(np.concatenate([r[0] for r in runs_of]))
        columns = [pa.array(texts, pa.int64())]
        for text, first, last in runs_of:
            ends = pa.array(np.searchsorted(text, texts).tolist() + [len(text)], pa.int32())
            columns += [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (first - REACH, last)]
        yield pa.record_batch(columns, ["c", *_ANSWERS])

    back = boxes.groupBy("part").applyInArrow(compare, _BOXES)
    return _stored(back.groupBy("part").applyInArrow(join_runs, "c long, " + ", ".join(f"{name} array<int>" for name in _ANSWERS)))


def _window_flags(size: int, first: np.ndarray, last: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per byte: does a window of these runs start there? ``starts`` and ``ends`` are those of each
    run's piece; windows that do not fit it are none."""
    first, last = np.maximum(first, starts), np.minimum(last, ends - LENGTH)
    fits = last >= first
    edges = np.bincount(first[fits], minlength=size + 1) - np.bincount(last[fits] + 1, minlength=size + 1)
    return np.cumsum(edges)[:size] > 0


def merge_windows(cut: DataFrame, answers: DataFrame, parts: int) -> DataFrame:
    """Step 3: ``c, firsts, lasts``: runs of windows (by their first bytes) that a smaller id has."""

    def flagged(batch: pa.RecordBatch):
        """Groups of stretches, with the places of their settled and of their other asked windows."""
        runs_of = {}
        for kind in ("settled", "asked"):
            lists = [batch.column(f"{kind}_{end}") for end in ("from", "to")]
            runs_of[kind] = (lists[0].offsets.to_numpy().astype(np.int64), *(x.values.to_numpy().astype(np.int64) for x in lists))
        for data, starts, ends, owner, _ in groups(batch.column("data")):
            flags = {}
            for kind, (bounds, first, last) in runs_of.items():
                sizes = bounds[owner + 1] - bounds[owner]
                piece = np.repeat(np.arange(len(owner)), sizes)
                pick = _ranges(bounds[owner], sizes)
                flags[kind] = _window_flags(len(data), first[pick] + starts[piece], last[pick] + starts[piece], starts[piece], ends[piece])
            yield data, starts, owner, flags["settled"], flags["asked"] & ~flags["settled"]

    def rows_of(batch: pa.RecordBatch, prints: Prints, other: Prints):
        number, ids = batch.column("c").to_numpy(), batch.column("id").to_numpy()
        for data, starts, owner, _, asked in flagged(batch):
            at = np.flatnonzero(asked)
            which = np.searchsorted(starts, at, "right") - 1
            prints.read(data)
            other.read(data)
            yield prints.of(at, at + LENGTH), other.of(at, at + LENGTH), number[owner[which]], at - starts[which], ids[owner[which]]

    def known(batches):
        for batch in batches:
            number = batch.column("c").to_numpy()
            for _, starts, owner, settled, _ in flagged(batch):
                at = np.flatnonzero(settled)
                which = np.searchsorted(starts, at, "right") - 1
                yield _runs_per_text(number[owner[which]], at - starts[which])

    def open_rows(batches):
        return _sent(batches, rows_of, _reduce_ids, parts, Prints(2), Prints(3))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _compared(batches, parts)

    def join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _runs_per_text(*_replies(batches)[True])

    joined = cut.select("c", "id", "data").join(answers.hint("merge"), "c")
    found = "c long, firsts array<int>, lasts array<int>"
    boxes = joined.where(F.size("asked_from") > 0).mapInArrow(open_rows, _BOXES)
    back = boxes.groupBy("part").applyInArrow(compare, _BOXES)
    merged = back.groupBy("part").applyInArrow(join_runs, found)
    return joined.where(F.size("settled_from") > 0).mapInArrow(known, found).unionByName(merged)


def _runs_per_text(text: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Window starts, in order within a text, as runs, a row per text."""
    return _per_text(*_joined_runs(text, at, 1), names=["c", "firsts", "lasts"])


# -- results ----------------------------------------------------------------------------------

def repeated_spans(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """``key, gone``: per text the runs of bytes that go, as gaps and lengths in varints; stored."""
    texts = _texts(docs, copies)
    keys = stored(texts.select("t", "key"))
    cut = stretches(texts)
    discard(texts)
    size = cut.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    parts = _parts(size * len(COVER) / PERIOD, docs.sparkSession)
    answers = name_triples(cut, parts)
    spread = F.aggregate(F.zip_with("asked_from", "asked_to", lambda a, b: b - a + 1), F.lit(0).cast("long"), lambda n, x: n + x)
    asked = answers.agg(F.sum(spread)).first()[0] or 0
    windows = merge_windows(cut, answers, _parts(asked, docs.sparkSession))
    moved = windows.join(cut.select("c", "t", "begin").hint("merge"), "c").select(
        "t", *[F.transform(n, lambda x: x + F.col("begin")).alias(n) for n in ("firsts", "lasts")])
    found = moved.join(keys.hint("merge"), "t").groupBy("key").agg(*[F.flatten(F.collect_list(n)).alias(n) for n in ("firsts", "lasts")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs_of = []
            for firsts, lasts in zip(batch.column("firsts"), batch.column("lasts")):
                first, last = (x.values.to_numpy().astype(np.int64) for x in (firsts, lasts))
                order = np.argsort(first, kind="stable")
                first, reach = first[order], np.maximum.accumulate(last[order]) + LENGTH
                new = np.flatnonzero(np.r_[True, first[1:] > reach[:-1]])
                starts, ends = first[new], reach[np.append(new[1:], len(first)) - 1]
                runs_of.append(np.stack([starts - np.append(0, ends[:-1]), ends - starts], 1).ravel())
            steps, width = _varints(np.concatenate(runs_of))
            sizes = np.add.reduceat(width, np.cumsum([0, *map(len, runs_of)])[:-1])
            yield pa.record_batch([batch.column("key"), _cut_bytes(steps, sizes)], ["key", "gone"])

    return _stored(found.mapInArrow(pack, "key binary, gone binary"))


def _kept(text: bytes, copy: bool, gone: bytes | None) -> tuple[int, int, int, str, bytes]:
    n = len(text)
    if copy and n >= LENGTH:
        removed, spans, rest = n, 1, b""
    elif gone is None:
        removed, spans, rest = 0, 0, text
    else:
        bounds = np.cumsum(_from_varints(np.frombuffer(gone, np.uint8))[0]).tolist()
        edges = [0, *bounds, n]
        rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
        removed, spans = n - len(rest), len(bounds) // 2
    return n, removed, spans, hashlib.sha256(rest).hexdigest(), rest


def without_repeats(docs: DataFrame, with_rest: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per document; ``with_rest`` adds the
    remaining bytes as ``rest`` (a removed run may end within a character)."""
    copies = copied_texts(docs)
    spans = repeated_spans(docs, copies)
    side = F.broadcast(spans) if fits_broadcast(spans, SPAN_BYTES) else spans.hint("merge")
    marked = keyed(docs).join(copies.withColumn("copied", F.lit(True)), "key", "left").join(side, "key", "left")
    copy = F.coalesce(F.col("copied"), F.lit(False)) & ~F.col("doc_id").eqNullSafe(F.col("first"))
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "rest"][:4 + with_rest]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary() if batch.column("text").type == pa.string() else pa.large_binary())
            rows = [_kept(t.as_py(), c, g) for t, c, g in zip(texts, batch.column("copy").to_pylist(), batch.column("gone").to_pylist())]
            columns = [pa.array([r[k] for r in rows], types[k]) for k in range(len(names))]
            yield pa.record_batch([batch.column("doc_id"), *columns], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", rest binary" * with_rest
    return marked.select("doc_id", "text", copy.alias("copy"), "gone").mapInArrow(run, schema)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))
