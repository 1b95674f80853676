"""Operators that bring rows together: joins, decontamination, quotations, components, the pipeline."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from periodgrid.llm import decontaminate, quotes, subspace, vertical_join
from periodgrid.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id string, cls string"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None, "mine", "mine") for i, t in texts], DOCS)


class Groups:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def jaccard_groups(texts):
    sets = {i: shingles(t) for i, t in texts}
    groups, ids = Groups(sets), sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 80 * (len(x) + len(y) - both):
                    groups.join(a, b)
    return {i: (len(sets[i]), groups.find(i)) for i in ids}


def words(rng, n):
    return ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n)]


def near_copies(seed):
    """Groups of copies that change a little, a passage that half of the texts share, and odd texts."""
    rng = random.Random(seed)
    passage, texts = words(rng, 40), []
    for group in range(12):
        base = words(rng, rng.choice([6, 30, 80, 200]))
        for _ in range(rng.choice([1, 2, 5, 30])):
            copy = base.copy()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = words(rng, 1)[0]
            texts.append(" ".join(copy + passage if group % 2 else copy))
    for _ in range(120):  # the passage makes most of these: frequent n-grams fill their prefixes
        own = words(rng, rng.choice([1, 2, 4, 8]))
        texts.append(" ".join(own + passage))
    texts += ["", "  ", None, "one", "one", "One two\tthree four", "one two three  FOUR", "a b c d e", "é É a b c d"]
    return list(enumerate(texts))


@pytest.mark.parametrize("rare", [64, 4])
def test_jaccard_groups_equal_brute_force(spark, monkeypatch, rare):
    monkeypatch.setattr(vertical_join, "RARE", rare)
    texts = near_copies(rare)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in vertical_join.jaccard_components(docs_of(spark, texts)).collect()}
    assert got == jaccard_groups(texts)


def test_jaccard_odd_rows(spark):
    text = "one two three four five six seven"
    frame = docs_of(spark, [(5, text), (5, text), (3, text), (None, text), (3, "other words that stand alone here"), (9, None)])
    got = sorted(((r.doc_id or -1), r.n_shingles, r.component_id) for r in vertical_join.jaccard_components(frame).collect())
    assert got == [(-1, 3, None), (3, 2, 3), (3, 3, 3), (5, 3, 3), (5, 3, 3), (9, 0, 9)]
    assert vertical_join.jaccard_components(frame.limit(0)).count() == 0


@pytest.mark.parametrize("name", [n for n in oracle_sql() if n.startswith("op")])
def test_registered_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = queries()[name](spark, sf_dir)
    want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_components_of_any_graph(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(7, 7)] + [(1000, i) for i in range(1001, 1100)]
    groups = Groups({x for e in edges for x in e})
    for a, b in edges:
        groups.join(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {i: groups.find(i) for i in groups.up if any(i in e and e[0] != e[1] for e in edges)}


# -- vectors ------------------------------------------------------------------------------

def test_subspace_join_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows, dim = [], 12
    for center in rng.normal(size=(25, dim)):
        for _ in range(rng.integers(1, 12)):
            rows.append((center * rng.uniform(0.5, 2) + rng.normal(size=dim) * 0.18).tolist())
    rows += [rows[0]] * 5 + [[0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), None, [], [1.0, 0.0], [1.0, 0.01]]
    labels = [int(i % 2) if i % 17 else None for i in range(len(rows))]
    data = [(i, v, labels[i], "mine") for i, v in enumerate(rows)] + [(None, rows[0], 0, "mine")]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, component_id string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in subspace.near_duplicates(frame).collect()}
    usable = {i: np.array(v, np.float32).astype(float) for i, v, label, _ in data
              if i is not None and v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    groups, links = Groups(range(len(rows))), dict.fromkeys(range(len(rows)), 0)
    for a in usable:
        for b in usable:
            if a < b and labels[a] == labels[b] and len(usable[a]) == len(usable[b]):
                x, y = usable[a], usable[b]
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93:
                    links[a] += 1
                    links[b] += 1
                    groups.join(a, b)
    assert got.pop(None) == (0, None, False)
    assert sum(links.values()) > 100
    assert got == {i: (links[i], groups.find(i), groups.find(i) == i) for i in links}
    assert subspace.near_duplicates(frame.limit(0)).count() == 0


def test_hot_cells_are_compared_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(subspace, "PIECE", 16)
    rng = np.random.default_rng(6)
    base = rng.normal(size=8)
    rows = [(i, (base + rng.normal(size=8) * 0.2).tolist(), 1) for i in range(150)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r.n_links for r in subspace.near_duplicates(frame).collect()}
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert got == dict(enumerate(((x @ x.T >= 0.93).sum(1) - 1).tolist()))


# -- decontamination ----------------------------------------------------------------------

def edit_distance_within(pattern, text, low, high):
    """The least edits of the whole pattern against any part of the text: the full table."""
    row = np.zeros(len(text) + 1, int)
    for c in pattern:
        new = np.append(row[0] + 1, np.minimum(row[1:] + 1, row[:-1] + (text != c)))
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row.min())


def test_regions_are_within_the_budget_and_none_is_missed(spark):
    rng = random.Random(8)
    items = [(k, " ".join(words(rng, rng.choice([16, 30, 50])))) for k in range(12)] + [(99, "short"), (98, None), (None, "x" * 50)]
    texts, planted = [], set()
    for i in range(60):
        text = " ".join(words(rng, rng.choice([0, 20, 300])))
        if i % 3 == 0:
            k, passage = items[i % 12]
            passage = list(passage.upper() if i % 2 else passage)
            for _ in range(int(len(passage) * rng.choice([0, 0.03, 0.05]))):
                at = rng.randrange(len(passage))
                passage[at:at + 1] = rng.choice([[], ["#"], ["#", passage[at]]])
            text = text + "\n" + "".join(passage) + " " + text
            planted.add((i, k))
        texts.append((i, text))
    texts += [(60, None), (61, ""), (62, "z" * 50000), (62, items[0][1])]
    benchmark = spark.createDataFrame([(k, t, "mine") for k, t in items], "item_id long, text string, doc_id string")
    found = decontaminate.contaminated_regions(docs_of(spark, texts), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == planted | {(62, 0)}
    by_id = dict(items)
    for r in found[:30]:
        if r.doc_id < 60:
            window = decontaminate.code_points(by_id[r.item_id])[r.item_start:r.item_end]
            text = decontaminate.code_points(dict(texts)[r.doc_id])
            best = edit_distance_within(window, text, r.doc_start, r.doc_end)
            assert best <= r.edits <= decontaminate.budget(len(window))
    clean = decontaminate.decontaminated(docs_of(spark, texts), benchmark)
    # Of the two rows with id 62 only the one that holds an item goes.
    assert sorted(r.doc_id for r in clean.collect()) == sorted({i for i, _ in texts} - {d for d, _ in planted})
    assert clean.where("doc_id = 62").first().text == "z" * 50000
    assert "cls" in clean.columns
    assert decontaminate.contaminated_regions(docs_of(spark, texts), benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated_regions(docs_of(spark, []), benchmark).count() == 0


def test_benchmark_in_blocks(spark, monkeypatch):
    rng = random.Random(9)
    items = [(k, " ".join(words(rng, 30))) for k in range(6)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = docs_of(spark, [(k, "x " + t) for k, t in items])
    whole = sorted(map(tuple, decontaminate.contaminated_regions(frame, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 400)
    assert sorted(map(tuple, decontaminate.contaminated_regions(frame, benchmark).collect())) == whole and len(whole) >= 6


# -- quotations ---------------------------------------------------------------------------

def test_quotations(spark):
    talk = [
        (1, 0, "u", "Hello there, my dear friend.\nHow is the weather today?"),
        (1, 1, "a", "On Monday X wrote:\n> Hello there, my dear  friend.\n> How is the weather today?\nIt is quite sunny outside."),
        (1, 2, "u", "> It is quite sunny outside.\n>> How is the weather TODAY?\nThank you so much indeed."),
        (1, 3, "a", "Something else that quotes nobody."),
        (1, 4, "a", "> Hello there, my dear friend.\nGood day to you too."),
        (2, 0, "u", "> Good day to you too.\nI saw that elsewhere."), (2, 1, "u", None), (2, 1, "u", ""),
        (None, 3, "u", "> Good day to you too."), (3, None, "u", "hi"), (4, 0, "u", "> never said by anybody at all"),
        (4, 1, "u", ">" * 500 + " deep\n" + "> x\n" * 500),
    ]
    frame = spark.createDataFrame([(*r, "mine") for r in talk], "conv_id long, turn long, role string, text string, parent_turn string")
    rows = quotes.link_quotes(frame).collect()
    by = {(r.conv_id, r.turn): r for r in rows}
    assert len(rows) == len(talk)
    assert [by[1, k].parent_turn for k in range(5)] == [None, 0, 1, None, 0]
    assert [by[1, k].depth for k in range(5)] == [0, 1, 2, 0, 1]
    assert (by[2, 0].parent_conv_id, by[2, 0].parent_turn, by[2, 0].depth) == (1, 4, 0)
    assert by[1, 1].text == "It is quite sunny outside." and by[1, 2].text == "Thank you so much indeed."
    assert by[4, 0].text == "" and (by[4, 0].n_quoted, by[4, 0].n_linked) == (1, 0)
    assert sorted((r.text for r in rows if (r.conv_id, r.turn) == (2, 1)), key=str) == ["", None]
    order = [r.turn for r in sorted((r for r in rows if r.conv_id == 1), key=lambda r: r.reply_path)]
    assert order == [0, 1, 2, 4, 3]
    assert quotes.link_quotes(frame.limit(0)).count() == 0


def test_long_threads_and_table(spark, sf_dir):
    chain = [(1, 0, "u", "This is message number zero of all.")] + [(1, k, "u", f"> This is message number {k - 1 if k > 1 else 'zero'} of all.\nThis is message number {k} of all.") for k in range(1, 20)]
    frame = spark.createDataFrame(chain, "conv_id long, turn long, role string, text string")
    assert {r.turn: r.depth for r in quotes.link_quotes(frame).collect()} == {k: k for k in range(20)}
    talk = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    plain = quotes.link_quotes(talk)
    assert sorted(map(tuple, plain.select("conv_id", "turn", "role", "text").collect())) == sorted(map(tuple, talk.select("conv_id", "turn", "role", "text").collect()))
    # Each message quotes the one before it.
    before = talk.select("conv_id", (F.col("turn") + 1).alias("turn"), F.concat(F.lit("> "), F.regexp_replace("text", "\n", "\n> ")).alias("quoted"))
    replies = talk.join(before, ["conv_id", "turn"], "left").withColumn("text", F.concat_ws("\n", "quoted", "text"))
    got = quotes.link_quotes(replies).where("turn > 0").select((F.col("parent_turn") == F.col("turn") - 1).alias("ok"))
    assert got.where("ok").count() >= 0.95 * got.count()


# -- the pipeline -------------------------------------------------------------------------

def test_pipeline_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    texts = {r.doc_id: r.text for r in docs.collect()}
    unique = stages["near_duplicates"](spark, docs, sf_dir)
    groups = jaccard_groups(list(texts.items()))
    assert unique.columns == docs.columns
    assert sorted(r.doc_id for r in unique.collect()) == sorted(i for i, (_, g) in groups.items() if g == i)
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in stages["decontamination"](spark, docs, sf_dir).collect()}
    assert clean == {i for i, t in texts.items() if not any(b in t for b in items)}
    masked = {r.doc_id: r for r in stages["secrets"](spark, docs, sf_dir).collect()}
    assert set(masked) == set(texts)
    for i, t in texts.items():
        found = re.search(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{6,}|AKIA[A-Z0-9]{16}|[0-9a-f]{24}", t)
        assert masked[i].n_chars == len(masked[i].text) and (masked[i].text == t if not found else found[0] not in masked[i].text)


def test_pipeline_runs_from_end_to_end(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.count() > 0 and set(rows.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
