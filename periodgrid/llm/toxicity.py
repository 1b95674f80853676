"""Convolutional text classifier for toxicity (operator 2).

A word is the mean of hashed embeddings of itself and of its first three to six letters, so that
inflected and compound forms share what they begin with. Filters of one, two and three words run
over the whole text; each filter keeps its largest answer; a logistic layer reads these. The net
is trained in numpy on a bounded sample of labelled texts and applied to every text in Arrow
batches. Decision thresholds are calibrated by language on all labelled texts kept out of training:
these are scored on Spark and counted per language, score step and label.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import counted_side, slices, stored

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 15, 16, 8, (1, 2, 3)
#: Pieces of a word: itself and its first three to six letters.
PIECES = 5
#: Bound of the sample: labelled rows per class to train on.
TRAIN_PER_CLASS = 2000
#: Steps between scores 0 and 1 in which labelled rows are counted for the thresholds.
SCORE_STEPS = 1 << 14
STEPS, BATCH, RATE = 450, 32, 0.01
PREDICT_AT = 0.7
#: Words convolved at a time.
STRETCH = 1 << 18

_NOT_WORD = re.compile(r"\W+")


def _pieces(word: str) -> list[int]:
    bare = _NOT_WORD.sub("", word)
    parts = [f"={bare}", *(f"{n}{bare[:n]}" for n in (3, 4, 5, 6) if len(bare) >= n)]
    return [xxhash.xxh32_intdigest(p) % BUCKETS for p in parts]


def _coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per distinct word its piece buckets (padded with ``BUCKETS``), all word codes, words per text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    words = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    known = coded.dictionary.to_pylist()
    table = np.full((len(known) + 1, PIECES), BUCKETS, np.uint16)
    for row, word in zip(table, known):
        buckets = _pieces(word)
        row[:len(buckets)] = buckets
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if "" in known:
        real = codes != known.index("")
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[real], minlength=len(sizes)).astype(np.int64)
        codes = codes[real]
    return table, codes, sizes


def _padded(codes: np.ndarray, sizes: np.ndarray, blank: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes with blanks after each text, so that no filter reaches into the next one; the starts."""
    gap = max(WIDTHS) - 1
    starts = np.cumsum(sizes + gap) - (sizes + gap)
    out = np.full(int((sizes + gap).sum()), blank, np.int64)
    out[np.arange(len(codes)) + gap * np.repeat(np.arange(len(sizes)), sizes)] = codes
    return out, starts


@dataclass
class TextCnn:
    """Embeddings, filters (width, place, DIM, FILTERS), their biases, and the logistic layer."""

    embed: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    shift: float

    @classmethod
    def fresh(cls, seed: int = 7) -> TextCnn:
        rng = np.random.default_rng(seed)
        embed = rng.normal(0, 0.1, (BUCKETS + 1, DIM)).astype(np.float32)
        embed[BUCKETS] = 0
        filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        return cls(embed, filters, bias, rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)

    def words(self, table: np.ndarray) -> np.ndarray:
        """Embeddings of words: the mean of their pieces; the last row (blank) is zero."""
        total = np.zeros((len(table), DIM), np.float32)
        for piece in table.T:  # one at a time keeps the memory small
            total += self.embed[piece]
        return total / np.maximum((table < BUCKETS).sum(1, keepdims=True), 1).astype(np.float32)

    def logits(self, table: np.ndarray, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        words = self.words(table)
        places = [[words @ f[j] for j in range(len(f))] for f in self.filters]
        scores = np.full(len(sizes), self.shift, np.float64)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + STRETCH, "right")))
            got, owner = _pooled(places, codes[ends[at] - sizes[at]:ends[to - 1]], sizes[at:to], len(words) - 1)
            for k, top in enumerate(got):
                answer = np.maximum(top + self.bias[k], 0)
                scores[at + owner] += answer @ self.out[k * FILTERS:(k + 1) * FILTERS]
            at = to
        return scores


def _pooled(places: list, codes: np.ndarray, sizes: np.ndarray, blank: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The largest answer of each filter in each text that has words; which texts these are."""
    padded, starts = _padded(codes, sizes, blank)
    owner = np.flatnonzero(sizes)
    if not len(owner):
        return [], owner
    cuts = np.stack([starts[owner], starts[owner] + sizes[owner]], 1).ravel()
    tops = []
    for parts in places:
        answers = parts[0][padded]
        for j in range(1, len(parts)):
            answers[:-j] += parts[j][padded[j:]]
        tops.append(np.maximum.reduceat(answers, cuts, axis=0)[::2])
    return tops, owner


def train(texts: list[np.ndarray], labels: np.ndarray, base_rate: float, seed: int = 7) -> TextCnn:
    """Adam over balanced batches of texts (pieces per word); the output is shifted to ``base_rate`` afterwards."""
    net, rng = TextCnn.fresh(seed), np.random.default_rng(seed)
    pools = [np.flatnonzero(labels == k) for k in (0, 1)]
    params = [net.embed, *net.filters, *net.bias, net.out]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, STEPS + 1):
        chosen = np.concatenate([rng.choice(p, BATCH // 2) for p in pools])
        sizes = np.array([len(texts[i]) for i in chosen])
        pieces = np.concatenate([*(texts[i] for i in chosen), BLANK])
        held = np.maximum((pieces < BUCKETS).sum(1), 1).astype(np.float32)
        padded, starts = _padded(np.arange(len(pieces) - 1), sizes, len(pieces) - 1)
        words = net.words(pieces)
        owner = np.flatnonzero(sizes)
        grads = [np.zeros_like(p) for p in params]
        tops, best = [], []
        for f in net.filters:
            answers = (words @ f[0])[padded]
            for j in range(1, len(f)):
                answers[:-j] += (words @ f[j])[padded[j:]]
            where = np.stack([starts[i] + answers[starts[i]:starts[i] + sizes[i]].argmax(0) for i in owner])
            best.append(where)
            tops.append(np.take_along_axis(answers, where, 0))
        hidden = np.zeros((len(chosen), len(WIDTHS) * FILTERS), np.float32)
        hidden[owner] = np.maximum(np.concatenate([t + b for t, b in zip(tops, net.bias)], 1), 0)
        logit = hidden @ net.out + net.shift
        error = (1 / (1 + np.exp(-logit)) - labels[chosen]) / len(chosen)
        grads[-1] += hidden.T @ error + 1e-4 * net.out
        back = np.where(hidden > 0, error[:, None] * net.out, 0)[owner]
        for k, f in enumerate(net.filters):
            d = back[:, k * FILTERS:(k + 1) * FILTERS].astype(np.float32)
            grads[1 + len(WIDTHS) + k] += d.sum(0)
            for j in range(len(f)):
                word = padded[best[k] + j]
                grads[1 + k][j] += np.einsum("tf,tfd->df", d, words[word])
                pull = (d[:, :, None] * f[j].T[None]) / held[word][:, :, None]
                for piece in range(pieces.shape[1]):
                    np.add.at(grads[0], pieces[word, piece].ravel(), pull.reshape(-1, DIM))
        grads[0][BUCKETS] = 0
        net.shift -= RATE * float(error.sum())
        for p, g, (m, v) in zip(params, grads, moments):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.shift += float(np.log(base_rate / (1 - base_rate)))
    return net


def fold(doc_id: str = "doc_id") -> Column:
    """Third of a document: 1 is held out, labels of the others may be learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3, F.lit(0))


BLANK = np.full((1, PIECES), BUCKETS, np.uint16)


def _texts(rows: DataFrame) -> tuple[list[np.ndarray], list]:
    """A bounded sample on the driver: per text the pieces of its words, and the rows' other columns."""
    got = rows.toArrow()
    texts = []
    for part in slices(got.column("text")):
        table, codes, sizes = _coded(part)
        texts += np.split(table[codes], np.cumsum(sizes)[:-1])
    return texts, got.drop_columns("text").to_pylist()


def _scored(net: TextCnn | None, rate: float, frame: DataFrame) -> DataFrame:
    """Rows of ``frame`` with their score; without a net every score is the base rate."""
    shared = frame.sparkSession.sparkContext.broadcast(vars(net) if net else None)  # plain data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = TextCnn(**shared.value) if shared.value else None
        for batch in batches:
            if model is None:
                scores = np.full(batch.num_rows, rate)
            else:
                scores = np.concatenate([_sigmoid(model.logits(*_coded(part))) for part in slices(batch.column("text"))])
            yield pa.record_batch([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])

    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, T.StructField("score", T.DoubleType())]))


def fit(documents: DataFrame, labels: DataFrame) -> tuple[TextCnn | None, dict[str | None, float], float]:
    """The net, thresholds by language (None: any other), and the base rate of label 1."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").where(fold() != 1)
    rated = known.agg(F.avg("toxic").alias("rate"), F.min("toxic").alias("low"), F.max("toxic").alias("high")).first()
    if rated["low"] != 0 or rated["high"] != 1:
        return None, {None: PREDICT_AT}, float(rated["rate"] or 0.0)
    drawn = F.xxhash64(F.lit(11), "doc_id")
    picked = known.withColumn("draw", drawn).withColumn("train", F.pmod("draw", F.lit(5)) < 4)
    sample = reduce(DataFrame.unionByName, (picked.where(f"train and toxic = {k}").orderBy("draw", "doc_id").limit(TRAIN_PER_CLASS) for k in (0, 1)))
    sample = stored(sample.select("doc_id", "toxic", "draw"))
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    # At most 2 * TRAIN_PER_CLASS ids: a bounded side.
    pieces, rows = _texts(texts.join(F.broadcast(sample), "doc_id").orderBy("draw", "doc_id", F.xxhash64("text")))
    label = np.array([r["toxic"] for r in rows], np.float32)
    if len(set(label)) < 2:
        return None, {None: PREDICT_AT}, float(rated["rate"])
    net = train(pieces, label, min(max(float(rated["rate"]), 0.01), 0.99))
    # Every labelled row that was not trained on counts, as one of its language, score step and label.
    others = counted_side(known.join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_anti"))
    step = F.floor(F.col("score") * SCORE_STEPS).alias("step")
    counts = _scored(net, 0.0, texts.join(others, "doc_id")).groupBy("lang", step, "toxic").count().collect()
    score = np.array([(c["step"] + 0.5) / SCORE_STEPS for c in counts])
    found = thresholds([c["lang"] for c in counts], score, np.array([c["toxic"] for c in counts]), weight=np.array([c["count"] for c in counts]))
    return net, found, float(rated["rate"])


def thresholds(langs: list, score: np.ndarray, label: np.ndarray, least: int = 10, weight: np.ndarray | None = None) -> dict[str | None, float]:
    """Per language the threshold of the best F1, half-way to the next score below.

    ``weight``: rows that an entry stands for. A language needs ``least`` rows of each class, else the
    common threshold holds; that one comes from whatever rows there are and is ``PREDICT_AT``
    only where a class has none.
    """
    found: dict[str | None, float] = {None: PREDICT_AT}
    langs = np.array(langs, object)
    weight = np.ones(len(score)) if weight is None else weight
    for lang in [None, *sorted({x for x in langs if x is not None})]:
        mine = np.ones(len(score), bool) if lang is None else langs == lang
        s, y, w = score[mine], label[mine], weight[mine]
        if min(w[y == 0].sum(), w[y == 1].sum()) < (1 if lang is None else least):
            continue
        order = np.argsort(-s, kind="stable")
        s, y, w = s[order], y[order], w[order]
        hits, total = np.cumsum(y * w), (y * w).sum()
        f1 = 2 * hits / (np.cumsum(w) + total)
        f1[:-1][s[:-1] == s[1:]] = -1
        best = int(f1.argmax())
        below = s[best + 1] if best + 1 < len(s) else 0.0
        found[lang] = float(np.clip((s[best] + below) / 2, 0.3, 0.9))
    return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``documents`` with ``score`` (0 to 1), ``threshold`` of its language and ``rejected``.

    All columns stay; columns of these three names are replaced. Only the text shapes the score;
    the language only picks the threshold. A null or blank text scores what the net says of no
    words. A null or unknown language takes the common threshold. Labels that are null or not 0
    or 1 are not learned from; without both classes there is no net and every score is the base
    rate. Repeated rows score alike. No rows give no rows.
    """
    net, limits, rate = fit(documents, labels)
    scored = _scored(net, rate, documents.drop("score", "threshold", "rejected"))
    limit = F.lit(limits[None])
    for lang, value in limits.items():
        if lang is not None:
            limit = F.when(F.col("lang") == lang, F.lit(value)).otherwise(limit)
    return scored.withColumn("threshold", limit).withColumn("rejected", F.col("score") >= F.col("threshold"))
