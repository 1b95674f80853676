"""Repeated strings against a plain search of every window."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from periodgrid.llm import suffixes as S

SCHEMA = "doc_id long, text string, lang string, key string, t long, copied int"


def brute(rows):
    """Per row the result by the definition; a null id is larger than all others."""
    texts = [((1 << 63) - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, text in texts:
        for k in range(len(text) - 49):
            window = text[k:k + 50]
            least[window] = min(least.get(window, i), i)
    found = []
    for (doc_id, _), (i, text) in zip(rows, texts):
        gone = bytearray(len(text))
        for k in range(len(text) - 49):
            if least[text[k:k + 50]] < i:
                gone[k:k + 50] = b"\1" * 50
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        rest = bytes(b for b, g in zip(text, gone) if not g)
        found.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(found, key=repr)


def result(spark, rows, slices=3):
    df = spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA).repartition(slices)
    return sorted(map(tuple, S.without_repeats(df).collect()), key=repr)


def corpus(seed, n):
    """Texts over few words, with passages of all lengths near the bound at every alignment."""
    rng = random.Random(seed)
    words = ["la", "tasa", "über", "mercado", "of", "the", "日本", "región", "x" * 30]
    passages = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(40, 130))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(1, 4))]
        for k in range(1, len(parts)):
            passage = rng.choice(passages)
            cut = rng.randint(0, 20)
            parts[k] = passage[cut:rng.randint(len(passage) - 20, len(passage))] + parts[k]
        rows.append((rng.choice([i, i, i, 3, None]), "".join(parts)))
    rows += [(i + 1000, rows[i][1]) for i in range(0, n, 7)] + [rows[0], rows[0], (5000, None), (5001, "")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,cut,held", [(1, 1 << 20, 1 << 22), (2, 120, 1 << 22), (3, 1 << 20, 30)])
def test_against_every_window(spark, monkeypatch, seed, cut, held):
    """The second case cuts texts into overlapping pieces, the third sends rows in many small boxes."""
    monkeypatch.setattr(S, "CUT", cut)
    monkeypatch.setattr(S, "HELD", held)
    rows = corpus(seed, 90)
    got = result(spark, rows)
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 1000


def test_cover():
    assert {(a - b) % S.PERIOD for a in S.COVER for b in S.COVER} == set(range(S.PERIOD))


def test_edges(spark):
    a = "".join(chr(33 + (i * 7) % 90) for i in range(50))
    rows = [(1, a), (2, "§" + a + "!"), (3, a[:49]), (4, a + a), (2, "other" + a[1:]), (None, a), (None, None), (7, "q" * 49)]
    got = result(spark, rows)
    assert got == brute(rows)
    assert [r[2:4] for r in got if r[0] == 4] == [(100, 1)] and [r[2] for r in got if r[0] is None] == [0, 50]


def test_long_runs_and_hot_lines(spark):
    """A very long text of one byte, and a line that every text has, each in other surroundings."""
    rng = random.Random(5)
    line = "This line of more than fifty bytes stands in each and every document.\n"
    rows = [(i, "".join(rng.choice("abcdef ") for _ in range(80)) + line + "".join(rng.choice("ghijk ") for _ in range(60))) for i in range(150)]
    rows += [(200, " " * 30_000), (201, "x" + " " * 20_000 + "y"), (202, " " * 60)]
    assert result(spark, rows) == brute(rows)


def test_no_rows_and_rest(spark):
    assert result(spark, []) == []
    twice = "0123456789" * 6
    df = spark.createDataFrame([(2, "ab" + twice + "cd"), (1, twice)], "doc_id long, text string")
    assert {r.doc_id: bytes(r.rest) for r in S.without_repeats(df, with_rest=True).collect()} == {1: twice.encode(), 2: b"abcd"}


def test_varints_come_back():
    numbers = np.array([0, 127, 128, 16383, 16384, 1 << 34, 5])
    data, width = S._varints(numbers)
    assert width.tolist() == [1, 1, 2, 2, 3, 5, 1] and S._from_varints(data)[0].tolist() == numbers.tolist()


def test_places_come_back():
    text = np.repeat(np.array([5, 7, 1 << 40]), [3, 1, 4])
    at = np.array([0, 2, 9, 1, 3, 3, 8, 1 << 30])
    back = S._unplaces(S._places(text, at), 8)
    assert back[0].tolist() == text.tolist() and back[1].tolist() == at.tolist()


def test_prints_tell_substrings_by_content():
    data = np.frombuffer(b"abcabcabd", np.uint8)
    prints = S.Prints(1)
    prints.read(data)
    three = prints.all(3).tolist()
    assert three[0] == three[3] != three[6] and len(set(three)) == 4
    assert prints.of(np.array([3]), np.array([6]))[0] == three[0]
    assert list(S.groups(pa.array([], pa.string()))) == []
