"""Near-duplicate vectors by a subspace pigeonhole join (operator 8).

Unit vectors with cosine c lie at a squared distance of 2 - 2c. After a rotation they are split
into blocks of few dimensions. The squared distances of the blocks add up to the whole, so a pair
within the budget is within its share of the budget in at least one block. Each block is joined by
range: vectors stand in cells of a grid over the block's first dimensions, twice as wide as the
radius, and visit the neighbour cells that their radius reaches. A pair that passes a block is
verified on the whole vectors in double precision, in the first block it passes only.

Equal vectors of a label are one class. Cells that hold many vectors are dealt in pieces, and
pieces meet in pairs, so no task holds a whole hot cell. Tasks give back numbers of links and a
spanning forest of their links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import components, stored

COSINE = 0.93
BLOCK = 8
#: Dimensions of a block that make the grid.
GRID = 2
#: Vectors of a piece of a cell; two pieces are compared at a time.
PIECE = 1024
#: Vectors whose covariance gives the rotation. It shapes the cells only: any rotation is exact.
SAMPLE = 4096
SLACK = 1e-6


def rotation(sample: np.ndarray, dim: int) -> np.ndarray:
    """Principal axes, dealt over the blocks so that each block gets some of the widest ones."""
    if len(sample) < 2:
        return np.eye(dim)
    _, axes = np.linalg.eigh(np.cov(sample, rowvar=False).reshape(dim, dim))
    axes = axes[:, ::-1]
    blocks = -(-dim // BLOCK)
    order = [k for b in range(blocks) for k in range(b, dim, blocks)]
    return axes[:, order]


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(lists: pa.Array, dim: int) -> np.ndarray:
    rows = _matrix(lists, dim)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _blocks(dim: int) -> list[slice]:
    return [slice(a, min(a + BLOCK, dim)) for a in range(0, dim, BLOCK)]


def _shares(dim: int, cosine: float) -> list[float]:
    """Each block's share of the squared distance, by its dimensions, with room for rounding."""
    return [(2 - 2 * cosine) * (b.stop - b.start) / dim + SLACK for b in _blocks(dim)]


def _cells(classes: DataFrame, axes, dim: int, cosine: float) -> DataFrame:
    """Each vector in its own cell of every block, and as a guest in cells its radius reaches."""
    shares = _shares(dim, cosine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turned = _unit(batch.column("embedding"), dim) @ axes.value
            rows, blocks, cells, guests = [], [], [], []
            for k, (block, share) in enumerate(zip(_blocks(dim), shares)):
                radius = float(np.sqrt(share))
                ground = turned[:, block][:, :GRID]
                home = np.floor(ground / (2 * radius)).astype(np.int64)
                for step in product((-1, 0, 1), repeat=home.shape[1]):
                    # Only to cells that come earlier: of two vectors one visits the other.
                    if step > (0,) * len(step):
                        continue
                    gap = np.where(np.array(step) < 0, ground - home * 2 * radius, np.where(np.array(step) > 0, (home + 1) * 2 * radius - ground, 0))
                    near = np.flatnonzero((gap**2).sum(1) <= share + SLACK)
                    rows.append(near)
                    blocks.append(np.full(len(near), k))
                    cells += [",".join(map(str, c)) for c in (home[near] + np.array(step)).tolist()]
                    guests.append(np.full(len(near), any(step)))
            at = np.concatenate(rows)
            cells = pa.array(cells, pa.string())
            kept = [batch.column(c).take(pa.array(at)) for c in ("vec_id", "label", "copies", "embedding")]
            yield pa.record_batch([*kept, pa.array(np.concatenate(blocks), pa.int32()), cells, pa.array(np.concatenate(guests))], ["vec_id", "label", "copies", "embedding", "block", "cell", "guest"])

    return classes.mapInArrow(run, "vec_id long, label long, copies long, embedding array<float>, block int, cell string, guest boolean")


def _links(dealt: DataFrame, axes, dim: int, cosine: float) -> DataFrame:
    """Per task pair of pieces: links per vector, and a forest that joins what they link."""
    shares, blocks = _shares(dim, cosine), _blocks(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        block = table.column("block")[0].as_py()
        ids, copies = table.column("vec_id").to_numpy(), table.column("copies").to_numpy()
        guest = table.column("guest").to_numpy(zero_copy_only=False).astype(bool)
        first, second = (table.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("as_left", "as_right"))
        raw = _matrix(table.column("embedding"), dim)
        length = np.sqrt((raw * raw).sum(1))
        turned = (raw / length[:, None]) @ axes.value
        left, right = np.flatnonzero(first & ~guest), np.flatnonzero(second)
        links = np.zeros(len(ids), np.int64)
        root = np.arange(len(ids))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        own = turned[:, blocks[block]]
        for at in range(0, len(left), PIECE):
            some = left[at:at + PIECE]
            x, y = own[some], own[right]
            near = (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T <= shares[block] + SLACK
            i, j = np.nonzero(near)
            i, j = some[i], right[j]
            # Home with home once, home with guest always.
            ok = (ids[i] != ids[j]) & (guest[j] | (ids[i] < ids[j]))
            i, j = i[ok], j[ok]
            for k in range(block):  # an earlier block has the pair
                gap = turned[i][:, blocks[k]] - turned[j][:, blocks[k]]
                ok = (gap * gap).sum(1) > shares[k]
                i, j = i[ok], j[ok]
            ok = (raw[i] * raw[j]).sum(1) / (length[i] * length[j]) >= cosine
            i, j = i[ok], j[ok]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            for a, b in zip(i.tolist(), j.tolist()):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        held = np.flatnonzero(links)
        top = np.array([find(k) for k in held.tolist()], np.int64)
        yield pa.record_batch([pa.array(ids[held]), pa.array(ids[top] if len(held) else np.zeros(0, np.int64)), pa.array(links[held])], ["vec_id", "joined", "links"])

    return dealt.groupBy("block", "label", "cell", "one", "two").applyInArrow(run, "vec_id long, joined long, links long")


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Links by cosine >= ``cosine`` between vectors of one label, and their components.

    Input: vec_id, embedding, label. Output, one row per vector: vec_id, n_links (other vectors
    linked directly), component_id (smallest vec_id reachable, itself included), kept (vec_id =
    component_id). Vectors with a null label, null or empty embedding, a null or non-finite
    component or no length link with nothing, nor do rows without a vec_id (null component, not
    kept). Vectors of different lengths never link. Repeated rows each count as a vector; rows that
    repeat a vec_id with another vector are one node, whose links add up. Extra columns are not
    read. No rows give no rows.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<float>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0))
    usable = usable.withColumn("dim", F.size("embedding"))
    # -0.0 equals 0.0; the hash of the values names the class, the values confirm it.
    usable = usable.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0).cast("float")))
    classes = stored(usable.groupBy("label", "dim", "embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")))
    counts, forests = [], []
    spark = embeddings.sparkSession
    for (dim,) in classes.select("dim").distinct().orderBy("dim").collect():  # lengths of vectors: one as a rule
        mine = classes.where(F.col("dim") == dim)
        sample = mine.orderBy(F.xxhash64("embedding"), "vec_id").limit(SAMPLE).select("embedding").toArrow()
        axes = spark.sparkContext.broadcast(rotation(_unit(sample.column(0).combine_chunks(), dim), dim))
        cells = stored(_cells(mine.select("vec_id", "label", "copies", "embedding"), axes, dim, cosine))
        sizes = cells.groupBy("block", "label", "cell").agg(F.count("*").alias("n"), F.sum(F.when(F.col("guest"), 0).otherwise(1)).alias("homes"))
        # Cells without a vector at home, or with one vector alone, have no pairs.
        sizes = sizes.where("n > 1 and homes > 0").withColumn("pieces", F.ceil(F.col("n") / PIECE).cast("int")).select("block", "label", "cell", "pieces")
        cut = cells.join(sizes, ["block", "label", "cell"]).withColumn("piece", F.pmod(F.xxhash64("vec_id"), F.col("pieces")).cast("int"))
        # Each vector goes as the left side to all pieces, and as the right side from all pieces.
        either = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        roles = either.withColumn("role", F.explode(F.when(F.col("piece") == F.col("other"), F.array(F.lit(0))).otherwise(F.array(F.lit(1), F.lit(2)))))
        dealt = roles.where("not (guest and role = 1)").select(
            "vec_id", "copies", "embedding", "block", "label", "cell", "guest",
            F.when(F.col("role") == 2, F.col("other")).otherwise(F.col("piece")).alias("one"),
            F.when(F.col("role") == 2, F.col("piece")).otherwise(F.col("other")).alias("two"),
            (F.col("role") != 2).alias("as_left"), (F.col("role") != 1).alias("as_right"))
        found = stored(_links(dealt, axes, dim, cosine))
        counts.append(found.select("vec_id", "links"))
        forests.append(found.where("vec_id <> joined").select(F.col("vec_id").alias("src"), F.col("joined").alias("dst")))
    each = rows.select("vec_id", "label", F.transform("embedding", lambda x: x + F.lit(0.0).cast("float")).alias("embedding"))
    if not counts:
        return each.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    links, edges = counts[0], forests[0]
    for more, forest in zip(counts[1:], forests[1:]):
        links, edges = links.unionByName(more), edges.unionByName(forest)
    total = links.groupBy("vec_id").agg(F.sum("links").alias("links"))
    groups = components(edges).withColumnRenamed("id", "vec_id")
    known = classes.join(total, "vec_id", "left").join(groups, "vec_id", "left").select(
        "label", "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "vec_id").alias("component"))
    usable_id = F.col("vec_id").isNotNull()
    joined = each.join(known, ["label", "embedding"], "left")
    component = F.when(usable_id, F.coalesce("component", "vec_id"))
    return joined.select(
        "vec_id", F.when(usable_id, F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
