"""Clashing names, null and repeated ids, long runs of blanks, and quotes of several sayers."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from periodgrid.llm.decontaminate import decontaminated
from periodgrid.llm.packing import default_tokenizer, encoder, pieces, slow_coder, token_ids
from periodgrid.llm.quotes import link_quotes
from periodgrid.llm.sanitise import EMAIL, GENERALISE, disclosing_terms
from periodgrid.llm.secrets import without_secrets
from periodgrid.llm.spans import matches

PASSAGE = "the quick brown fox of the benchmark jumps over every lazy dog that sleeps in the warm afternoon sun of june " * 2


def test_secrets_keep_columns_of_any_name(spark):
    names = ["_hex", "_base", "_assign", "_access", "_random", "_spans", "row", "text", "doc_id"]
    df = spark.createDataFrame([(*["keep"] * 7, "token = abcdef123456 end", 1)], ", ".join(f"{n} string" for n in names[:-1]) + ", doc_id long")
    row = without_secrets(df).first()
    assert row.__fields__ == names and [row[n] for n in names[:7]] == ["keep"] * 7
    assert "abcdef123456" not in row.text and row.text.endswith(" end")


def test_decontamination_tells_rows_by_text(spark):
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    rows = [(None, "x " + PASSAGE, "a"), (7, PASSAGE, "b"), (7, "a clean text", "c"), (None, "clean too", "d"), (9, None, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _dirty string")
    assert sorted(r._dirty for r in decontaminated(df, items).collect()) == ["c", "d", "e"]


def test_copies_go_by_row(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(5, text), (1, text), (5, "another text of its own words here"), (None, text + " end"), (8, "lone words only here"), (8, "lone words only here"),
            (None, "no id but words of its own"), (3, ""), (4, None), (None, " ")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.without_copies(spark, df, "").collect()]
    assert sorted(kept, key=repr) == sorted([rows[1], rows[2], rows[4], *rows[6:]], key=repr)


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 1_200_000, "a" + " " * 1_000_000 + "b\n" + "\t" * 700_000])
def test_long_runs_of_blanks(spark, text):
    ids = token_ids(text, encoder(default_tokenizer()))
    assert ids.tolist() == slow_coder().encode(text, add_special_tokens=False).ids
    rows = pieces(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert sum(r.length for r in rows) == len(ids) + 1


def test_a_quote_finds_the_other_sayer(spark):
    """A later message of the own conversation says it too; the one of another conversation counts."""
    said = "this sentence is long enough to tell"
    rows = [(1, 3, f"> {said}\nI agree"), (1, 5, said), (2, 0, said), (3, 1, said)]
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    row = link_quotes(df).where("conv_id = 1 and turn = 3").first()
    assert (row.n_quoted, row.n_linked, row.parent_conv_id, row.parent_turn) == (1, 1, 2, 0)


@pytest.mark.parametrize("seed", range(3))
def test_parents_against_plain_search(spark, seed):
    """One-line quotes over several conversations, early and late sayers: equal to a search by hand."""
    rng = random.Random(seed)
    pool = [f"sentence number {i} says something rather special" for i in range(14)]
    said, rows = {}, []
    for conv in range(8):
        for turn in rng.sample(range(12), 7):
            own = rng.choice(pool)
            quoted = rng.choice(pool) if rng.random() < 0.6 else None
            said[conv, turn] = own
            rows.append((conv, turn, "user", (f"> {quoted}\n" if quoted else "") + own, quoted))
    want = {}
    for conv, turn, _, _, quoted in rows:
        here = [t for (c, t), own in said.items() if c == conv and t < turn and own == quoted]
        first_of = {}
        for (c, t), own in said.items():
            if own == quoted and c != conv:
                first_of[c] = min(t, first_of.get(c, t))
        if quoted and here:
            want[conv, turn] = (conv, min(here))
        elif quoted and first_of:
            want[conv, turn] = (min(first_of), first_of[min(first_of)])
        else:
            want[conv, turn] = (None, None)
    df = spark.createDataFrame([r[:4] for r in rows], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.parent_conv_id, r.parent_turn) for r in link_quotes(df).collect()}
    assert got == want


def test_numbers_beside_an_entity_are_rated(spark):
    line = "employee EMP4471 born 19740312 on srv42 mail jo.doe@example.org"
    rows = [(1, line), (2, line)] + [(10 + i, f"the employee was born in spring and got mail number {i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = {r.term: r.share for r in disclosing_terms(df).collect()}
    assert {"emp4471", "19740312", "srv42"} <= set(terms) and "born" not in terms and "mail" not in terms
    assert all(terms[t] >= GENERALISE for t in ("emp4471", "19740312", "srv42"))


def test_places_of_many_matches(spark):
    """Places over several blocks of pieces, with and without a group, equal to Python's."""
    rng = random.Random(6)
    texts = ["".join(rng.choice(["a1", "é2b", " ", "x", "33", "\n"]) for _ in range(n)) for n in (0, 1, 63, 64, 65, 700, 5000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern, group in ((r"([a-zé])([0-9])", 2), (r"[0-9]+", None)):
        got = df.select(matches(F.col("t"), pattern, group).alias("m")).collect()
        for text, row in zip(texts, got):
            want = [(m.start(), m.end(), m.group(), m.group(group) if group else None) for m in re.finditer(pattern, text)]
            assert [tuple(s) for s in row.m] == want


def test_time_of_many_matches(spark):
    def seconds(n):
        df = spark.createDataFrame([("jo.doe@example.org and " * n,)], "t string").select(F.size(matches(F.col("t"), EMAIL)).alias("n"))
        start = time.perf_counter()
        assert df.first().n == n
        return time.perf_counter() - start

    seconds(100)
    assert seconds(32_000) <= 10 * max(seconds(8_000), 0.5)
