"""The divergence audit against a count in plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from periodgrid.llm import divergence as D

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))) for text, lang, source in rows]
    found = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= 3}
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(t for t in terms if t in kept)
        whole = sum(counts.values(), Counter())

        def share(c):
            base = sum(c.values()) + len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // base for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in counts:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, ranked, most in (("pair", pairs, None), ("term", terms, 200)):
                ranked.sort(key=lambda x: (-x[0], x[1].encode()))
                found += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked[:most], 1)]
    return sorted(found)


def audit(spark, rows, slices=3):
    df = spark.createDataFrame([(*r, i, 7, "c") for i, r in enumerate(rows)], "text string, lang string, source string, doc_id long, n long, term string")
    return sorted(map(tuple, D.divergence_audit(df.repartition(slices)).select(*COLUMNS).collect()))


def words(rng, vocabulary, n):
    return "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", ", ", "-", "\t\t", ". "]) for _ in range(n))


@pytest.mark.parametrize("small", [False, True])
def test_against_plain_counts(spark, monkeypatch, small):
    if small:  # many flushes, many parts
        monkeypatch.setattr(D, "HELD_ROWS", 40)
        monkeypatch.setattr(D, "PART_BYTES", 300)
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in ("The", "día", "x1y", "größe", "ÀB", "日本", "o'neil", "e") for b in ("", "s", "ing", "é", "Q")]
    rows = []
    for _ in range(160):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["a", "b", "ü", None])
        rows.append((words(rng, vocabulary, rng.randint(0, 30)), lang, source))
    rows += [("twin twin", "en", "a"), ("Twin,", "en", "a"), ("twin", "en", "b"), (rows[0][0], *rows[0][1:])]
    rows += [(None, "en", "only null"), ("", "zz", "a"), ("... 12", "zz", "b"), (None, None, None)]
    assert audit(spark, rows) == brute(rows)


def test_chunks_that_share_a_term_in_one_document(spark):
    """Two documents with three spellings are two documents; a third one makes the term count."""
    rows = [("word, (word) Word. 1word1", "en", "a"), ("word WORD", "en", "b")]
    assert {r[4] for r in audit(spark, rows)} == {0}
    rows.append(("'word'", "en", "b"))
    got = audit(spark, rows)
    assert got == brute(rows) and len([r for r in got if r[2] == "pair"]) == 2


def test_very_long_and_hot(spark):
    rows = [("a" * 300_000 + " hot" * 50_000, "en", "big")] * 3 + [("hot cold", "en", f"s{i % 5}") for i in range(40)]
    assert audit(spark, rows) == brute(rows)


def test_ranks_end_at_the_bound_with_ties(spark):
    some = " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300))
    rows = [(some, "en", "a")] * 3 + [("other", "en", "b")] * 4
    got = audit(spark, rows)
    assert got == brute(rows) and max(r[5] for r in got) == 200


def test_no_documents(spark):
    assert audit(spark, []) == []


def test_shares_do_not_overflow():
    import numpy as np

    for count, total, kept in ((0, 1, 1), (9 * 10 ** 13, 9 * 10 ** 13, 5), (7 * 10 ** 12 + 3, 8 * 10 ** 13, 999)):
        assert D.shares(np.array([count]), total, kept)[0] == 1 + 10 ** 9 * (count + 1) // (total + kept)
