"""What a task of the near-duplicate join holds at once, in bytes for each letter or n-gram."""

import tracemalloc

import numpy as np
import pyarrow as pa

from periodgrid.llm import vertical_join
from periodgrid.llm.shingles import word_hashes


def peak_of(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_word_hashes_take_few_letters_at_once():
    texts = pa.array(["wordswords " * 400_000])
    assert len(word_hashes(texts)[0]) == 400_000
    assert peak_of(lambda: word_hashes(texts)) < 100e6  # 4 MB of letters


def fragment(blocks, docs, each, seed=1):
    """Blocks as tasks write them: every n-gram but a few stands in one document."""
    rng, rows = np.random.default_rng(seed), []
    for block in range(blocks):
        gram = np.sort(rng.integers(0, 1 << 62, docs * each, np.uint64))
        owner = np.arange(docs * each) % docs
        told = np.zeros(docs, vertical_join.OWNER)
        told["key"] = np.frombuffer(rng.bytes(8 * docs), "V8")
        told["n"], told["rare"], told["ends"] = 5 * each, each, 0xFFFF
        rows.append((block, gram.tobytes(), owner.astype("<u4").tobytes(), np.zeros(len(gram), "<u4").tobytes(), told.tobytes()))
    kinds = [pa.int32()] + [pa.binary()] * 4
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], ["part", "grams", "owners", "places", "told"])


def test_fragment_takes_few_bytes_for_an_ngram():
    batch = fragment(8, 500, 200)
    assert peak_of(lambda: list(vertical_join._partial_overlaps(iter([batch])))) < 45 * 8 * 500 * 200


def test_pairs_of_a_fragment_leave_in_stretches(monkeypatch):
    monkeypatch.setattr(vertical_join, "PAIRED", 1 << 12)
    one = fragment(1, 200, 5)
    same = one.set_column(1, "grams", pa.array([np.repeat(np.arange(5, dtype=np.uint64), 200).tobytes()], pa.binary()))
    found = list(vertical_join._partial_overlaps(iter([same])))
    assert len(found) > 1
    assert sum(sum(batch.column("shared").to_pylist()) for batch in found) == 5 * 200 * 199 // 2
