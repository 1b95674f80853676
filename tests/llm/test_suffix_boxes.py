"""Rows on their way to a part and back: what a box costs, since their number grows with the square of the input."""

import time

import numpy as np
import pyarrow as pa

from periodgrid.llm import suffixes as S


def rows(n, texts, seed=1):
    """Names, second names, texts, places and ids as a task holds them; ids are null, negative or far apart."""
    rng = np.random.default_rng(seed)
    text = np.sort(rng.choice(np.append(np.arange(texts - 2) + (7 << 33), [0, 1 << 43]), n))
    at = rng.integers(0, 1 << 31, n)
    ids = np.append(rng.integers(-(1 << 62), 1 << 62, texts - 2), [S.LAST_ID, -1 << 63])[np.unique(text, return_inverse=True)[1]]
    return rng.integers(0, 1 << 64, n, np.uint64), rng.integers(0, 1 << 64, n, np.uint64), text, at, ids


def test_rows_leave_for_all_parts_in_one_batch_and_come_back():
    name, second, text, at, ids = rows(20_000, 300)
    batches = list(S._open_boxes(name, second, text, at, ids, 3000))
    assert len(batches) == 1 and batches[0].num_rows > 2900
    (low, texts, places, seconds, owners), settled = S._opened(iter(batches), True)
    assert not settled
    low_bytes = lambda x, width: x & np.uint64((1 << 8 * width) - 1)
    sent = zip(low_bytes(name, S.NAME_BYTES), text, at, low_bytes(second, S.SECOND_BYTES), ids)
    assert sorted(map(tuple, sent)) == sorted(zip(low, texts, places, seconds, owners))


def test_replies_of_a_part_leave_in_one_batch(monkeypatch):
    _, _, text, at, _ = rows(20_000, 300, seed=2)
    cut = [(text[k::40], at[k::40]) for k in range(40)]  # as many settled boxes came to the part
    batches = list(S._settled_replies(cut, 500))
    assert len(batches) == 1
    back = S._replies(iter(batches))
    order = np.lexsort((at, text))
    assert back[True][0].tolist() == text[order].tolist() and back[True][1].tolist() == at[order].tolist()
    assert not len(back[False][0])
    monkeypatch.setattr(S, "HELD", 600)
    assert len(list(S._settled_replies(cut, 500))) == 20


def test_boxes_of_both_kinds_are_told_apart():
    name, second, text, at, ids = rows(50, 10)
    batches = [*S._settled_box(text[:20], at[:20], 7), *S._open_boxes(name, second, text, at, ids, 7)]
    mixed = pa.Table.from_batches(batches).combine_chunks().to_batches()
    columns, settled = S._opened(iter(mixed), True)
    assert len(columns[0]) == 50 and [x.tolist() for x in settled[0]] == [text[:20].tolist(), at[:20].tolist()]
    assert list(S._open_boxes(name[:0], second[:0], text[:0], at[:0], ids[:0], 7)) == []


def test_smaller_ids_of_equal_pairs():
    rng = np.random.default_rng(3)
    name, second = (rng.integers(0, 6, 400).astype(np.uint64) for _ in range(2))
    ids = rng.integers(0, 9, 400)
    pairs = list(zip(name.tolist(), second.tolist()))
    least = {p: min(i for q, i in zip(pairs, ids.tolist()) if q == p) for p in pairs}
    assert S._larger(name, second, ids).tolist() == [i > least[p] for p, i in zip(pairs, ids.tolist())]


def test_sampled_triples_are_those_of_the_cover():
    starts = np.array([0, 40, 40, 200, 700])
    ends = np.array([29, 70, 91, 251, 1000])
    expected = [(a, k) for k, (s, e) in enumerate(zip(starts, ends)) for a in range(max(e - s - S.TRIPLE + 1, 0)) if a % S.PERIOD in S.COVER]
    assert list(zip(*(x.tolist() for x in S.sampled(starts, ends)))) == expected


def test_a_stored_step_leaves_no_shuffle_and_the_setting_as_it_was(spark):
    def shuffled(store):
        before = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
        kept = store(spark.range(1000).repartition(4, "id"))
        for _ in range(50):  # files go a moment later
            now = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
            if now <= before:
                break
            time.sleep(0.1)
        return kept.count(), now - before

    setting = spark.conf.get(S.SHUFFLES_GO, None)
    rows, left = shuffled(S._stored)
    assert rows == 1000 and left <= 0
    assert spark.conf.get(S.SHUFFLES_GO, None) == setting
