"""Cross-entropy difference of two matched n-gram models (operator 3).

A target model (of the documents labelled good) and a background model (of all documents) share
one vocabulary, the order two and the smoothing, so that their losses can be subtracted token by
token. A document's score is the mean difference: below zero it reads more like the target.

All documents are counted, and every word is a word of the vocabulary: words are 64-bit hashes.
A loss needs three counts in each model: of the pair, of the word and of the word before. Counts of
the most frequent words and pairs are lists of bounded size that every task holds. Any other pair
of a document goes, in a few bytes, to the part where all its occurrences meet:

- a pair of two frequent words meets by the pair;
- a pair with a rare word meets by that word, whose own counts are then at hand as well;
- a pair with a rare word before it meets by the word before; if both are rare it goes there next.

Parts send back sums per document. Losses are whole numbers of 2^-32 nats, so sums do not depend on
the order of addition. The lists shape where a pair is scored, not the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import counted_side, parts_of, slices, stored
from .shingles import word_hashes
from .suffixes import _from_low_bytes, _low_bytes, _places, _spread, _squeezed, _unplaces

#: Words whose counts are sent to every task (40 bytes each), and pairs (24 bytes each).
HOT_WORDS, HOT_PAIRS = 1 << 18, 1 << 16
#: Occurrences in what a task holds from which a pair may be a frequent one.
OFTEN = 4
#: The word before a text.
START = 0
#: Weight of the pair's own frequency against the word's, and what is added to each word count.
OWN, ADDED = 0.7, 0.5
#: Tokens that a task holds, rows that meet in a part, and parts of a nat.
HELD, PART_ROWS = 1 << 19, 1 << 20
NAT = float(1 << 32)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BOXES = "part int, kind int, n int, names binary, seconds binary, places binary, numbers binary"
_BOX_NAMES = ["part", "kind", "n", "names", "seconds", "places", "numbers"]
#: What a box holds: pairs of frequent words, pairs with a rare word, pairs with a rare word before,
#: the same of a rare word, sums of documents.
PAIRS, RARE, BEFORE, BOTH, SUMS = range(5)


def _pairs(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before each word (``START`` for the first of a text), and a hash of both."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = START
    return before, _pair_hash(before, words)


def _pair_hash(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    h = (before ^ (before >> np.uint64(29))) * _ODD + words
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (((hashes * _ODD) >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a new value of any of these sorted columns begins."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _box(part: int, kind: int, n: int, *columns: bytes | None) -> pa.RecordBatch:
    return pa.record_batch([pa.array([part], pa.int32()), pa.array([kind], pa.int32()), pa.array([n], pa.int32()), *(pa.array([c], pa.binary()) for c in columns)], _BOX_NAMES)


def _boxes(kind: int, part: np.ndarray, name, second, text, n, numbers=(), width: int = 8) -> Iterator[pa.RecordBatch]:
    """Rows (name, second name, document, count, numbers) dealt to their parts."""
    if not len(part):
        return
    order = np.lexsort((n, text, part))
    for own in np.split(order, _starts(part[order])[1:]):
        yield _box(
            int(part[own[0]]), kind, len(own), None if name is None else _low_bytes(name[own], width), None if second is None else _low_bytes(second[own], 8),
            _places(text[own], n[own]), _squeezed(*(x[own] for x in numbers)) if len(numbers) else None)


def _opened(batches: Iterator[pa.RecordBatch], numbers: dict[int, int]) -> dict[int, list[np.ndarray]]:
    """The rows of a part by kind; ``numbers``: how many further numbers a kind has."""
    found: dict[int, list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            kind, n = row["kind"], row["n"]
            columns = list(_unplaces(row["places"], n))
            if row["names"] is not None:
                columns.append(_from_low_bytes(row["names"], len(row["names"]) // n))
            if row["seconds"] is not None:
                columns.append(_from_low_bytes(row["seconds"], 8))
            if numbers.get(kind):
                columns += _spread(row["numbers"], n, numbers[kind])
            found.setdefault(kind, []).append(columns)
    return {kind: [np.concatenate(c) for c in zip(*boxes)] for kind, boxes in found.items()}


# -- the models -------------------------------------------------------------------------------

class Model:
    """Counts of the frequent words (in all documents and in the target ones, as a word and as the
    word before; ``START`` is among them), and what all losses share. Plain arrays: it is broadcast."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, size: int, totals: tuple[int, int]):
        self.words, self.counts, self.size, self.totals = words, counts, size, totals

    def places(self, words: np.ndarray) -> np.ndarray:
        """The place of each word among the frequent ones, -1 for others."""
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, -1)

    def loss(self, model: int, pair: np.ndarray, word: np.ndarray, before: np.ndarray) -> np.ndarray:
        """-ln p from the three counts; ``model``: 0 for the background, 1 for the target."""
        p = (word + ADDED) / (self.totals[model] + ADDED * self.size)
        seen = before > 0
        own = pair / np.where(seen, before, 1)
        return np.rint(-np.log(np.where(seen, OWN * own + (1 - OWN) * p, p)) * NAT).astype(np.int64)

    def losses(self, pair: tuple, word: tuple, before: tuple) -> tuple[np.ndarray, np.ndarray]:
        return self.loss(1, pair[1], word[1], before[1]), self.loss(0, pair[0], word[0], before[0])

    def as_word(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.counts[0][at], self.counts[1][at]

    def as_before(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.counts[2][at], self.counts[3][at]


def _tokens(batch: pa.RecordBatch):
    """Stretches of a batch: first row, words, sizes, words before, pairs."""
    at = 0
    for part in slices(batch.column("text"), 1 << 20):
        words, sizes = word_hashes(part)
        words = np.where(words == START, np.uint64(1), words)
        before, pair = _pairs(words, sizes)
        yield at, words, sizes, before, pair
        at += len(part)


def count_words(docs: DataFrame, parts: int) -> tuple[Model, np.ndarray]:
    """The model's shared lists, and pairs that stand often in some task: candidates for the hot ones."""

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        words, inside, pair, ends, ends_inside = map(np.concatenate, zip(*held))
        every = np.concatenate([words, ends])
        keys, place = np.unique(every, return_inverse=True)
        w, e = place[:len(words)], place[len(words):]
        counts = [np.bincount(w, minlength=len(keys)), np.bincount(w[inside], minlength=len(keys)),
                  np.bincount(e, minlength=len(keys)), np.bincount(e[ends_inside], minlength=len(keys))]
        zero = np.zeros(len(keys), np.int64)
        yield from _boxes(0, _part(keys, parts), keys, None, zero, counts[0], counts[1:])
        pair = np.sort(pair)
        at = _starts(pair)
        n = np.diff(np.append(at, len(pair)))
        often = n >= OFTEN
        yield from _boxes(1, _part(pair[at[often]], parts), pair[at[often]], None, np.zeros(int(often.sum()), np.int64), n[often])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            target = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
            for at, words, sizes, _, pair in _tokens(batch):
                some = np.flatnonzero(sizes)
                last = np.cumsum(sizes)[some] - 1
                held.append((words, np.repeat(target[at:at + len(sizes)], sizes), pair, words[last], target[at + some]))
                size += len(words)
                if size >= HELD:
                    yield from flush(held)
                    held, size = [], 0
                    pa.default_memory_pool().release_unused()
        if size:
            yield from flush(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _opened(batches, {0: 3})
        rows = [[np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 4]] * 2
        if 0 in found:
            _, n, word, *more = found[0]
            order = np.argsort(word, kind="stable")
            at = _starts(word[order])
            sums = [np.add.reduceat(x[order], at) for x in (n, *more)]
            # Words that stand once are told by their number alone; START carries the part's totals.
            keep = sums[0] > 1
            total = [np.array([x]) for x in (sums[0].sum(), sums[1].sum(), sums[2].sum(), sums[3].sum())]
            rows[0] = [np.append(word[order][at][keep], np.uint64(START)), *(np.append(s[keep], t) for s, t in zip(sums, total))]
            extra = len(at)
        else:
            extra = 0
        if 1 in found:
            _, n, pair = found[1]
            order = np.argsort(pair, kind="stable")
            at = _starts(pair[order])
            zero = np.zeros(len(at), np.int64)
            rows[1] = [pair[order][at], np.add.reduceat(n[order], at), zero, zero, zero]
        for kind, columns in enumerate(rows):
            size = np.where(columns[0] == START, extra, 0)
            yield pa.record_batch([pa.array(np.full(len(columns[0]), kind), pa.int32()), *(pa.array(c.view(np.int64)) for c in columns), pa.array(size, pa.int64())],
                                  ["kind", "word", "w_all", "w_target", "e_all", "e_target", "size"])

    counted = docs.select("text", "target").mapInArrow(run, _BOXES).groupBy("part").applyInArrow(
        add, "kind int, word long, w_all long, w_target long, e_all long, e_target long, size long")
    counted = stored(counted)
    words = counted.where("kind = 0")
    total = words.where(F.col("word") == START).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("w_all", "w_target", "e_all", "e_target", "size")]).first()
    top = words.where(F.col("word") != START).orderBy(F.desc("w_all"), "word").limit(HOT_WORDS).toArrow()
    names = top.column("word").to_numpy().view(np.uint64)
    w_all, w_target, e_all, e_target = (top.column(c).to_numpy() for c in ("w_all", "w_target", "e_all", "e_target"))
    # A word is the word before as often as it ends no text; START is that of every text with words.
    counts = np.array([np.append(w_all, 0), np.append(w_target, 0), np.append(w_all - e_all, total.e_all), np.append(w_target - e_target, total.e_target)], np.int64)
    order = np.argsort(np.append(names, np.uint64(START)))
    model = Model(np.append(names, np.uint64(START))[order], counts[:, order], total.size, (total.w_all, total.w_target))
    pairs = counted.where("kind = 1").groupBy("word").agg(F.sum("w_all").alias("n")).orderBy(F.desc("n"), "word").limit(HOT_PAIRS).toArrow()
    return model, np.sort(pairs.column("word").to_numpy().view(np.uint64))


def hot_losses(docs: DataFrame, model: Model, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact counts of the given pairs, and their losses; pairs with a rare word are left out."""
    if not len(pairs):
        return pairs, np.zeros(0, np.int64), np.zeros(0, np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shared.value
        counts, words, befores = np.zeros((2, len(keys)), np.int64), np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint64)
        for batch in batches:
            target = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
            for at, word, sizes, before, pair in _tokens(batch):
                place = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
                known = keys[place] == pair
                place, inside = place[known], np.repeat(target[at:at + len(sizes)], sizes)[known]
                counts[0] += np.bincount(place, minlength=len(keys))
                counts[1] += np.bincount(place[inside], minlength=len(keys))
                words[place], befores[place] = word[known], before[known]
        some = counts[0] > 0
        yield pa.record_batch([pa.array(c[some].view(np.int64)) for c in (keys, words, befores, counts[0], counts[1])], ["pair", "word", "before", "n_all", "n_target"])

    added = docs.select("text", "target").mapInArrow(run, "pair long, word long, before long, n_all long, n_target long").groupBy("pair").agg(
        F.min("word").alias("word"), F.min("before").alias("before"), F.sum("n_all").alias("n_all"), F.sum("n_target").alias("n_target")).toArrow()
    pair, word, before = (added.column(c).to_numpy().view(np.uint64) for c in ("pair", "word", "before"))
    n = added.column("n_all").to_numpy(), added.column("n_target").to_numpy()
    w, b = model.places(word), model.places(before)
    keep = (w >= 0) & (b >= 0)
    target, background = model.losses(tuple(x[keep] for x in n), model.as_word(w[keep]), model.as_before(b[keep]))
    order = np.argsort(pair[keep])
    return pair[keep][order], target[order], background[order]


# -- scores -----------------------------------------------------------------------------------

def _pair_counts(text: np.ndarray, n: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by ``keys``: per row the occurrences of its key in all and in target documents
    (the last bit of a document's number)."""
    at = _starts(*keys)
    sizes = np.diff(np.append(at, len(n)))
    return np.repeat(np.add.reduceat(n, at), sizes), np.repeat(np.add.reduceat(n * (text & 1), at), sizes)


def _sums(text: np.ndarray, n: np.ndarray, target: np.ndarray, background: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document the sum of its losses."""
    order = np.argsort(text, kind="stable")
    at = _starts(text[order])
    return text[order][at], np.add.reduceat((n * target)[order], at), np.add.reduceat((n * background)[order], at)


def _meet(batches: Iterator[pa.RecordBatch], model: Model, parts: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a part scored; sums and pairs that must go on to the word before, to their parts."""
    found = _opened(batches, {SUMS: 4})
    sums = []
    if PAIRS in found:
        text, n, name = found[PAIRS]
        order = np.argsort(name, kind="stable")
        text, n, name = text[order], n[order], name[order]
        before, word = (x.astype(np.int64) for x in np.divmod(name, np.uint64(len(model.words))))
        sums.append(_sums(text, n, *model.losses(_pair_counts(text, n, name), model.as_word(word), model.as_before(before))))
    if RARE in found:
        text, n, word, before = found[RARE]
        order = np.lexsort((before, word))
        text, n, word, before = (x[order] for x in (text, n, word, before))
        pair, own = _pair_counts(text, n, word, before), _pair_counts(text, n, word)
        b = model.places(before)
        known = b >= 0
        if known.any():
            few = lambda xs: tuple(x[known] for x in xs)
            sums.append(_sums(text[known], n[known], *model.losses(few(pair), few(own), model.as_before(b[known]))))
        rest = ~known
        numbers = [x[rest] for x in (*pair, *own)]
        yield from _boxes(BOTH, parts + _part(before[rest], parts), before[rest], None, text[rest], n[rest], numbers)
    if BEFORE in found:
        text, n, before, word = found[BEFORE]
        yield from _boxes(BEFORE, parts + _part(before, parts), before, word, text, n)
    for text, target, background in sums:
        zero = np.zeros(len(text), np.int64)
        yield from _boxes(SUMS, _text_part(text, parts), None, None, text, zero, (target, background, zero, zero))
    if SUMS in found:  # those of the tasks only pass through
        text, n, *numbers = found[SUMS]
        yield from _boxes(SUMS, _text_part(text, parts), None, None, text, n, numbers)


def _text_part(text: np.ndarray, parts: int) -> np.ndarray:
    return ((text >> 34) * 31 + ((text & ((1 << 34) - 1)) >> 9)) % parts


def _end(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Sums of documents, and of the pairs with a rare word before, as rows."""
    found = _opened(batches, {SUMS: 4, BOTH: 4})
    rows = []
    if SUMS in found:
        text, n, target, background, doc, known = found[SUMS]
        order = np.argsort(text, kind="stable")
        at = _starts(text[order])
        rows.append((text[order][at], *(np.add.reduceat(x[order], at) for x in (n, target, background, doc, known))))
    befores = [c for c in (found.get(BEFORE), found.get(BOTH)) if c is not None]
    if befores:
        # All occurrences of a rare word as the word before are here.
        text, n, before = (np.concatenate([c[k] for c in befores]) for k in range(3))
        split = len(found[BEFORE][0]) if BEFORE in found else 0
        order = np.argsort(before, kind="stable")
        total = [np.empty(len(n), np.int64) for _ in range(2)]
        for out, counted in zip(total, _pair_counts(text[order], n[order], before[order])):
            out[order] = counted
        scored = []
        if split:
            t, m, b, word = found[BEFORE]
            order = np.lexsort((word, b))
            pair = [np.empty(split, np.int64) for _ in range(2)]
            for out, counted in zip(pair, _pair_counts(t[order], m[order], b[order], word[order])):
                out[order] = counted
            scored.append(model.losses(tuple(pair), model.as_word(model.places(word)), tuple(x[:split] for x in total)))
        if BOTH in found:
            p_all, p_target, w_all, w_target = found[BOTH][3:]
            scored.append(model.losses((p_all, p_target), (w_all, w_target), tuple(x[split:] for x in total)))
        t, target, background = _sums(text, n, *(np.concatenate(c) for c in zip(*scored)))
        zero = np.zeros(len(t), np.int64)
        rows.append((t, zero, target, background, zero, zero))
    for columns in rows:
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["t", "n_tokens", "target", "background", "doc", "known"])


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document the losses of its whole text under both models and their difference.

    Output: doc_id, n_tokens, target_loss, background_loss, score (means per token, in nats; score
    is target minus background). The target is every document labelled quality 1. A text without
    words has zero tokens and null losses. Null or other labels and ids name no target; without a
    target its model is the smoothing alone. A repeated row is counted as often as it occurs.
    Extra columns are not read. No rows give no rows.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("target")).distinct()
    marked = docs.join(counted_side(good), "doc_id", "left").withColumn("target", F.coalesce("target", F.lit(False)))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Some six bytes of text a token, most of which are a row of their own.
    parts = max(parts_of(spark), math.ceil(size / 6 / PART_ROWS))
    model, candidates = count_words(marked, parts)
    hot = hot_losses(marked, model, candidates)
    shared = spark.sparkContext.broadcast((vars_of(model), hot))

    def flush(held: list, model: Model) -> Iterator[pa.RecordBatch]:
        text, word, before, n = map(np.concatenate, zip(*held))
        w, b = model.places(word), model.places(before)
        both, rare = (w >= 0) & (b >= 0), w < 0
        name = b[both].astype(np.uint64) * np.uint64(len(model.words)) + w[both].astype(np.uint64)
        yield from _boxes(PAIRS, _part(name, parts), name, None, text[both], n[both], width=max(1, (len(model.words) ** 2).bit_length() + 7 >> 3))
        yield from _boxes(RARE, _part(word[rare], parts), word[rare], before[rare], text[rare], n[rare])
        late = ~both & ~rare
        yield from _boxes(BEFORE, _part(before[late], parts), before[late], word[late], text[late], n[late])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (keys, *tables) = Model(*shared.value[0]), shared.value[1]
        held, size = [], 0
        for batch in batches:
            number = batch.column("t").to_numpy() * 2 + batch.column("target").to_numpy(zero_copy_only=False).astype(np.int64)
            ids = batch.column("doc_id")
            known_id = np.array(ids.is_valid().to_numpy(zero_copy_only=False), np.int64)
            doc = ids.fill_null(0).to_numpy()
            for at, words, sizes, before, pair in _tokens(batch):
                place = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
                hot_here = keys[place] == pair if len(keys) else np.zeros(len(pair), bool)
                ends, own = np.cumsum(sizes), slice(at, at + len(sizes))
                in_place = []
                for values in tables:
                    run_up = np.append(0, np.cumsum(np.where(hot_here, values[place], 0) if len(keys) else np.zeros(len(pair), np.int64)))
                    in_place.append(run_up[ends] - run_up[ends - sizes])
                # Every text has a row of sums, with its words and its id.
                somewhere = np.full(len(sizes), number[at] % parts)
                yield from _boxes(SUMS, somewhere, None, None, number[own], sizes, (*in_place, doc[own], known_id[own]))
                owner, rest = np.repeat(number[own], sizes)[~hot_here], pair[~hot_here]
                order = np.lexsort((rest, owner))
                first = _starts(owner[order], rest[order])
                picked = np.flatnonzero(~hot_here)[order][first]
                held.append((owner[order][first], words[picked], before[picked], np.diff(np.append(first, len(rest)))))
                size += len(first)
                if size >= HELD:
                    yield from flush(held, model)
                    held, size = [], 0
                    pa.default_memory_pool().release_unused()
        if size:
            yield from flush(held, model)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _meet(batches, Model(*shared.value[0]), parts)

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _end(batches, Model(*shared.value[0]))

    numbered = marked.withColumn("t", F.monotonically_increasing_id())
    boxes = numbered.select("t", "doc_id", "target", "text").mapInArrow(run, _BOXES)
    ended = boxes.groupBy("part").applyInArrow(meet, _BOXES).groupBy("part").applyInArrow(
        end, "t long, n_tokens long, target long, background long, doc long, known long")
    summed = ended.groupBy("t").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "target", "background", "doc", "known")])
    mean = lambda c: F.when(F.col("n_tokens") > 0, F.col(c) / F.lit(NAT) / F.col("n_tokens"))
    return summed.select(
        F.when(F.col("known") > 0, F.col("doc")).alias("doc_id"), "n_tokens", mean("target").alias("target_loss"),
        mean("background").alias("background_loss"), (mean("target") - mean("background")).alias("score"))


def vars_of(model: Model) -> tuple:
    """A model as plain data, to be broadcast."""
    return model.words, model.counts, model.size, model.totals
