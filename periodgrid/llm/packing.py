"""Best-fit packing by bin completion (operator 5).

Texts become token ids; only a document longer than a sequence is cut, into full pieces after a
first piece that takes the remainder. Full pieces fill sequences of their own. The others are
dealt to groups of bounded size by a hash, and each group is packed by bin completion: the
largest length left opens a bin, the undominated fillings of its room are enumerated by branch
and bound on the waste, and the best one becomes the bin, as often as the counts allow. Lengths
repeat a lot, so a group is a count per length, not a list of pieces. Where that takes more bins
than the sum of the lengths asks for, the group is packed best-fit-decreasing as well, and the
packing with fewer bins stays. There is no branching over the bins of a group.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .common import stored

CAPACITY = 1024
END_ID = 2
#: Pieces of a group: a group wastes less than one sequence or so beyond the best packing.
GROUP_PIECES = 1 << 15
#: Nodes that the search for one bin's filling may visit before it keeps its incumbent.
NODES = 2000
SPECIAL = {"<|endoftext|>": 50256}


def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of ``path`` (a ranks file): the ids of the tokenizers file of that name."""
    import public_tokenizers

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def token_ids(text: str, coder: tiktoken.Encoding) -> np.ndarray:
    try:
        if any(token in text for token in SPECIAL):
            return np.array(coder.encode(text, allowed_special="all"), np.uint32)
        return coder.encode_to_numpy(text, disallowed_special=())
    except ValueError:  # a run of white space too long for that library's regular expressions
        return np.array(slow_coder().encode(text, add_special_tokens=False).ids, np.uint32)


@functools.cache
def slow_coder() -> Tokenizer:
    """The tokenizers file itself: the same ids for any text, several times as slow."""
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pieces(documents: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length, ids_crc32."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(token_ids(text.as_py(), coder), np.uint32(END_ID)).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                rows += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_filling(counts: np.ndarray, room: int) -> list[int]:
    """Lengths (with repeats) that fill ``room`` best, by branch and bound from the longest down.

    Depth first, longest first: the first filling found is the greedy one and serves as the
    incumbent. A length is taken by count, so the depth is the number of different lengths that fit
    together, some 45 of them. A branch ends when what it may still hold cannot beat the incumbent's waste. Of
    the lengths that leave no room for more only the longest is tried (the others' fillings are
    dominated); a filling without waste ends the search.
    """
    below = np.arange(len(counts))  # the longest length with a piece, at most i
    below[counts <= 0] = 0
    below = np.maximum.accumulate(below)
    held = np.flatnonzero(counts > 0)
    shortest = int(held[0]) if len(held) else 0
    total = np.cumsum(np.arange(len(counts)) * counts)
    best: tuple[int, list[int]] = (room + 1, [])
    chosen: list[tuple[int, int]] = []
    nodes = 0

    def walk(room: int, top: int) -> None:
        nonlocal best, nodes
        nodes += 1
        if room < best[0]:
            best = (room, [size for size, times in chosen for _ in range(times)])
        size = int(below[min(top, room)])
        while size > 0 and best[0]:
            if room - min(room, int(total[size])) >= best[0] or nodes > NODES:
                break
            lower = size - 1
            for times in range(min(int(counts[size]), room // size), 0, -1):
                if room - min(room, times * size + int(total[lower])) >= best[0] or nodes > NODES:
                    break
                chosen.append((size, times))
                walk(room - times * size, lower)
                chosen.pop()
            if room - size < shortest:  # shorter lengths that leave no room either are dominated
                lower = min(lower, room - shortest)
            size = int(below[max(lower, 0)])

    walk(room, room)
    return best[1]


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in it for each length: longest first, each to the bin with the least room that holds it."""
    bins = np.zeros(len(lengths), np.int64)
    places = np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    used = 0
    for at in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[at])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, used
            used += 1
        bins[at], places[at] = chosen, capacity - room
        by_room[room - size].append(chosen)
        rooms |= 1 << (room - size)
    return bins, places


def complete_bins(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in it for each length: bin completion, or best fit where that takes fewer bins."""
    packed = _completed(lengths, capacity)
    count = lambda found: int(found[0].max(initial=-1)) + 1
    if count(packed) > -(-int(lengths.sum()) // capacity):
        packed = min(packed, best_fit(lengths, capacity), key=count)
    return packed


def _completed(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin completion; the largest piece left always opens the next bin."""
    order = np.argsort(lengths, kind="stable")
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    ends = np.cumsum(counts)  # pieces of one length stand together in ``order``; taken from the end
    bins = np.zeros(len(lengths), np.int64)
    places = np.zeros(len(lengths), np.int64)
    used = 0
    top = capacity
    while True:
        while top > 0 and counts[top] == 0:
            top -= 1
        if top == 0:
            return bins, places
        counts[top] -= 1
        filling = best_filling(counts, capacity - top)
        counts[top] += 1
        pattern = [top, *filling]
        wanted = np.bincount(pattern, minlength=capacity + 1)
        times = int((counts[wanted > 0] // wanted[wanted > 0]).min())
        # The same filling again while it is whole: other bins of this length come to the same.
        offset = 0
        for size in pattern:
            taken = order[ends[size] - times:ends[size]]
            bins[taken] = used + np.arange(times)
            places[taken] = offset
            ends[size] -= times
            counts[size] -= times
            offset += size
        used += times


def pack(cut: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with sequence_id and offset: full pieces alone, all others by bin completion."""
    cut = stored(cut)
    part = cut.where(F.col("length") < capacity)
    groups = max(1, -(-part.count() // group_pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, places = complete_bins(table.column("length").to_numpy(), capacity)
        group = table.column("grp")[0].as_py()
        out = table.drop_columns("grp").append_column("sequence_id", pa.array(bins * groups + group)).append_column("offset", pa.array(places))
        yield from out.to_batches()

    dealt = part.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    packed = dealt.groupBy("grp").applyInArrow(run, schema)
    # Full pieces count down from -1, so that their numbers meet no other.
    alone = cut.where(F.col("length") >= capacity).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    return packed.unionByName(alone)


def packed_documents(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Every document of ``documents`` in sequences of at most ``CAPACITY`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or
    empty text is one piece that holds the end id. Rows with a null doc_id and repeated rows are
    packed like any other. Other columns are not read. No rows give no rows.
    """
    return pack(pieces(documents, tokenizer))
