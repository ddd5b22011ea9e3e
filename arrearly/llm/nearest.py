"""Approximate nearest neighbours by stable projections and a kd-tree.

Vectors are projected to ``DIMS`` dimensions with one Gaussian (2-stable)
matrix, so a projected squared distance over the true one follows a
chi-square law with ``DIMS`` degrees of freedom. The projected space is cut into cells of
about ``SHARD_ROWS`` rows by the upper levels of one kd-tree over a sample (``SAMPLE``
rows a length, at most ``CELLS`` cells; a vector length with too few rows is one cell). Each
cell becomes a kd-tree over its projected points, kept as one row; a cell that
holds more (the sample missed, or there are copies) becomes several, dealt by a hash of vec_id.
Every valid row is indexed; the sample decides only where cells end.

A query takes the projected neighbours in growing distance, leaf by leaf, and verifies them
with exact distances on the original vectors. It stops when the next leaf is so far that a
point beyond it is nearer than the k-th best with a chance of at most
``1 - CONFIDENCE`` (the chi-square test). It begins in its home cell; then it visits the
cells whose box passes the same test against the k-th best found at home, and no others.

Queries travel in blocks of at most about ``BLOCK`` rows of a cell, so a pair of a block and a
tree is bounded and all of them are spread over the cluster. The k best of each tree meet in a
ranking per query.

Equal vectors of a tree are one entry that keeps
their k + 1 smallest ids, which is exact for k neighbours under the rule for ties.

Defined results: null ids, and vectors that are null, empty, all zero or hold a
null or non-finite component take no part, as query or candidate. Vectors of
another length are no candidates of a query. Several rows of one vec_id count
as one, with its smallest vector. A distance too large for a double is infinite, and such
neighbours come last, by vec_id. With k candidates or fewer all are returned;
an empty table gives no rows. Only vec_id and embedding are read.
"""

from __future__ import annotations

import functools
import math
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

K = 10
DIMS = 8  # even: the chi-square law then has a closed form
CONFIDENCE = 0.97
SHARD_ROWS = 8_192
SAMPLE = 65_536
CELLS = 4_096
LENGTHS = 64  # vector lengths whose space is cut: the most frequent ones
LEAF = 32
BLOCK = 512
SEED = 20_14
NEIGHBOURS = "query_id long, vec_id long, score double"


def chi_square_cdf(x: float, dims: int = DIMS) -> float:
    half = x / 2
    return 1 - math.exp(-half) * sum(half**j / math.factorial(j) for j in range(dims // 2))


@functools.lru_cache
def stop_ratio(confidence: float = CONFIDENCE, dims: int = DIMS) -> float:
    """Projected over true distance at which the test holds."""
    lo, hi = 0.0, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_cdf(mid, dims) < confidence else (lo, mid)
    return math.sqrt(hi)


@functools.lru_cache(maxsize=8)
def projection(size: int, dims: int = DIMS) -> np.ndarray:
    return np.random.default_rng(SEED + size).standard_normal((size, dims))


def slack(point: np.ndarray) -> float:
    """What rounding may make of a projected distance of 0."""
    return 1e-9 * float(np.abs(point).max(initial=0.0))


class Cells:
    """The upper levels of a kd-tree: cuts of the projected space into cells."""

    def __init__(self, points: np.ndarray, cells: int):
        self.axis, self.cut, self.child = [], [], []
        self.count = 0
        self._part(points, cells)

    def _part(self, points: np.ndarray, cells: int) -> int:
        """Number of a node, or -1 - number of a cell."""
        wide = np.ptp(points, axis=0) if len(points) else np.zeros(1)
        if cells <= 1 or wide.max() == 0:
            self.count += 1
            return -self.count
        axis = int(wide.argmax())
        low = cells // 2
        order = np.sort(points[:, axis])
        cut = float(order[min(len(order) - 1, max(1, len(order) * low // cells))])
        if cut == order[0]:  # copies up to the cut: the cut goes above them
            cut = float(order[np.searchsorted(order, cut, side="right")])
        me = len(self.axis)
        self.axis.append(axis)
        self.cut.append(cut)
        self.child.append([0, 0])
        below = points[:, axis] < cut
        self.child[me][0] = self._part(points[below], low)
        self.child[me][1] = self._part(points[~below], cells - low)
        return me

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))] if self.axis else []
        while todo:
            node, own = todo.pop()
            above = points[own, self.axis[node]] >= self.cut[node]
            for side, part in ((0, own[~above]), (1, own[above])):
                to = self.child[node][side]
                if to < 0:
                    out[part] = -1 - to
                elif len(part):
                    todo.append((to, part))
        return out


class Tree:
    """kd-tree over projected points, as its leaves' boxes, with the original
    vectors in leaf order and the smallest ids of each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, keep: int, leaf: int = LEAF):
        self.dtype = vectors.dtype
        unique, which = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, which.ravel()))
        groups = np.split(ids[order], np.flatnonzero(np.diff(which.ravel()[order])) + 1)
        points = unique.astype(np.float64) @ projection(unique.shape[1])
        cuts: list[np.ndarray] = []
        todo = [np.arange(len(unique))]
        while todo:
            own = todo.pop()
            p = points[own]
            wide = np.ptp(p, axis=0)
            if len(own) <= leaf or wide.max() == 0:
                cuts.append(own)
                continue
            axis, half = int(wide.argmax()), len(own) // 2
            part = np.argpartition(p[:, axis], half)
            todo += [own[part[half:]], own[part[:half]]]
        self.ends = np.cumsum([len(c) for c in cuts])
        at = np.concatenate(cuts)
        self.low = np.array([points[c].min(axis=0) for c in cuts])
        self.high = np.array([points[c].max(axis=0) for c in cuts])
        self.vectors = unique[at]
        self.ids = [groups[i][:keep] for i in at]

    def search(self, query_id: int, query: np.ndarray, k: int = K, ratio: float | None = None, bound: float = math.inf) -> list[tuple[float, int]]:
        """The k nearest found, as (distance, id), without the query's own id. ``bound``: a
        k-th best distance known from elsewhere."""
        ratio = stop_ratio() if ratio is None else ratio
        p = query @ projection(len(query))
        gap = np.maximum(np.maximum(self.low - p, p - self.high), 0)
        far = np.sqrt((gap * gap).sum(axis=1)) - slack(p)
        order = np.argsort(far, kind="stable")
        best: list[tuple[float, int]] = []
        at, step = 0, 4
        while at < len(order):
            if far[order[at]] > ratio * (min(bound, best[-1][0]) if len(best) == k else bound):
                break
            leaves = order[at: at + step]
            own = np.concatenate([np.arange(self.ends[j - 1] if j else 0, self.ends[j]) for j in leaves.tolist()])
            diff = self.vectors[own].astype(np.float64) - query
            score = np.sqrt((diff * diff).sum(axis=1))
            near = np.flatnonzero(score <= best[-1][0]) if len(best) == k else np.arange(len(own))
            if len(near):
                near = near[np.argsort(score[near], kind="stable")]
                found = best + [(float(score[i]), int(v)) for i in near.tolist() for v in self.ids[own[i]] if v != query_id]
                best = sorted(found)[:k]
            at, step = at + step, min(step * 2, 64)
        return best


def valid(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding, dim) of the rows that take part."""
    e: Column = F.col("embedding")
    finite = F.forall(e, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    # NaN is larger than infinity for Spark, so the test above rejects it.
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .where(F.col("vec_id").isNotNull() & e.isNotNull() & finite & F.exists(e, lambda x: x != 0))
            .withColumn("dim", F.size("embedding")))


def _vectors(column: pa.Array, at: np.ndarray) -> np.ndarray:
    """Rows ``at`` (all of one length) of a column of vectors as a matrix."""
    return column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)


def _by_length(batch: pa.RecordBatch):
    """(length, rows, projected points) of each vector length of a batch."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        yield dim, at, _vectors(batch.column("embedding"), at).astype(np.float64) @ projection(dim)


def cells_of(rows: DataFrame, shard_rows: int = SHARD_ROWS, sample: int = SAMPLE, most: int = CELLS) -> dict[int, Cells]:
    """Cells of the projected space of the most frequent vector lengths with over ``shard_rows`` rows,
    by a sample of about ``sample`` rows each, chosen by a hash of vec_id."""
    large = rows.groupBy("dim").count().where(F.col("count") > shard_rows).orderBy(F.desc("count"), "dim").limit(LENGTHS).collect()
    out = {}
    for r in large:
        step = max(1, -(-r["count"] // sample))
        part = rows.where((F.col("dim") == r["dim"]) & (F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(step)) == 0))

        def project(batches):
            for b in batches:
                for _, _, points in _by_length(b):
                    yield pa.RecordBatch.from_arrays([pa.array(list(points), pa.list_(pa.float64()))], names=["point"])

        points = part.mapInArrow(project, "point array<double>").toArrow().column("point").combine_chunks()  # ``sample`` rows of DIMS numbers, about
        points = points.flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMS)
        out[r["dim"]] = Cells(points[np.lexsort(points.T)], min(most, -(-r["count"] // shard_rows)))
    return out


def in_cells(rows: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """``rows`` (vec_id, embedding, dim) with their cell."""
    known = rows.sparkSession.sparkContext.broadcast(cells)  # LENGTHS * CELLS cuts at most

    def run(batches):
        for b in batches:
            cell = np.zeros(b.num_rows, np.int32)
            for dim, at, points in _by_length(b):
                if dim in known.value:
                    cell[at] = known.value[dim].of(points)
            yield b.append_column("cell", pa.array(cell, pa.int32()))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, cell int")


SIDES = [f"{side}{i}" for side in ("low", "high") for i in range(DIMS)]


def index(rows: DataFrame, shard_rows: int = SHARD_ROWS, k: int = K) -> DataFrame:
    """One row per tree: its vector length and cell, the box of its points and
    the pickled tree. ``rows``: (vec_id, embedding, dim, cell)."""

    def build(key, pdf):
        pdf = pdf.assign(order=[tuple(v) for v in pdf["embedding"]]).sort_values(["vec_id", "order"]).drop_duplicates("vec_id")
        tree = Tree(pdf["vec_id"].to_numpy(np.int64), np.stack(pdf["embedding"].to_numpy()), k + 1)
        sides = dict(zip(SIDES, [*tree.low.min(axis=0), *tree.high.max(axis=0)]))
        return pd.DataFrame({"dim": [key[0]], "cell": [key[1]], "shard": [key[2]], "tree": [pickle.dumps(tree, 5)]} | {c: [x] for c, x in sides.items()})

    counts = rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    dealt = rows.join(counts, ["dim", "cell"]).withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int")).drop("shards")
    schema = "dim int, cell int, shard int, tree binary, " + ", ".join(f"{c} double" for c in SIDES)
    return dealt.groupBy("dim", "cell", "shard").applyInPandas(build, schema)


def _search(trees: DataFrame, asked: DataFrame, k: int, ratio: float, block: int) -> DataFrame:
    """The k nearest found in each tree. ``asked``: (vec_id, embedding, dim, cell, bound)."""
    counts = asked.groupBy("dim", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    blocks = (asked.join(counts, ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("blocks")))
              .groupBy("dim", "cell", "block").agg(F.collect_list(F.struct("vec_id", "embedding", "bound")).alias("queries")))
    shards = trees.groupBy("dim", "cell").agg(F.max("shard").alias("last"))
    # Pairs of a block and a tree are spread by tree, also those of a cell with many.
    blocks = blocks.join(shards, ["dim", "cell"]).withColumn("shard", F.explode(F.sequence(F.lit(0), "last"))).drop("last")

    def run(batches):
        last, tree = None, None
        for b in batches:
            for i in range(b.num_rows):
                place = tuple(b.column(c)[i].as_py() for c in ("dim", "cell", "shard"))
                if last != place:
                    last, tree = place, pickle.loads(b.column("tree")[i].as_buffer())
                queries = b.column("queries")[i].values
                ids, bounds = queries.field("vec_id").to_pylist(), queries.field("bound").to_pylist()
                vectors = queries.field("embedding").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1).astype(np.float64)
                found = [(q, v, s) for q, x, y in zip(ids, vectors, bounds) for s, v in tree.search(q, x, k, ratio, y)]
                cols = list(zip(*found)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                                                 names=["query_id", "vec_id", "score"])

    return trees.select("dim", "cell", "shard", "tree").join(blocks, ["dim", "cell", "shard"]).mapInArrow(run, NEIGHBOURS)


def visits(asked: DataFrame, bounds: DataFrame, trees: DataFrame, cells: dict[int, Cells], ratio: float) -> DataFrame:
    """(vec_id, embedding, dim, cell, bound): the cells besides its own that a query
    visits, those whose box is near enough under the chi-square test."""
    sides = [f(c).alias(c) for c, f in zip(SIDES, [F.min] * DIMS + [F.max] * DIMS)]
    found = trees.where(F.col("dim").isin(sorted(cells))).groupBy("dim", "cell").agg(*sides).toArrow()  # LENGTHS * CELLS boxes at most
    boxes = {}
    for dim in cells:
        own = found.filter(pa.array(found.column("dim").to_numpy() == dim))
        m = np.array([own.column(c).to_numpy() for c in SIDES]).reshape(2, DIMS, -1)
        boxes[dim] = own.column("cell").to_numpy(), m[0].T, m[1].T
    known = asked.sparkSession.sparkContext.broadcast(boxes)

    def run(batches):
        for b in batches:
            bound, home = b.column("bound").to_numpy(), b.column("cell").to_numpy()
            rows, to = [], []
            for dim, at, points in _by_length(b):
                if dim not in known.value:
                    continue
                cell, low, high = known.value[dim]
                for i, p in zip(at.tolist(), points):
                    gap = np.maximum(np.maximum(low - p, p - high), 0)
                    near = cell[~(np.sqrt((gap * gap).sum(axis=1)) - slack(p) > ratio * bound[i])]
                    near = near[near != home[i]]
                    rows += [i] * len(near)
                    to += near.tolist()
            for lo in range(0, len(rows), 8_192):
                part = b.take(pa.array(rows[lo: lo + 8_192], pa.int64()))
                yield part.set_column(part.schema.get_field_index("cell"), "cell", pa.array(to[lo: lo + 8_192], pa.int32()))

    known_bounds = asked.drop("bound").join(bounds, "vec_id", "left").withColumn("bound", F.coalesce("worst", F.lit(math.inf))).drop("worst")
    known_bounds = known_bounds.select("vec_id", "embedding", "dim", "cell", "bound")
    return known_bounds.mapInArrow(run, known_bounds.schema)


def nearest(rows: DataFrame, queries: DataFrame, k: int = K, confidence: float = CONFIDENCE, shard_rows: int = SHARD_ROWS,
            block: int = BLOCK, sample: int = SAMPLE, cells: int = CELLS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query."""
    candidates = valid(rows)
    space = cells_of(candidates, shard_rows, sample, cells)
    ratio = stop_ratio(confidence)
    trees = written(index(written(in_cells(candidates, space), "op3-rows"), shard_rows, k), "op3-index")
    asked = valid(queries).groupBy("vec_id").agg(F.min(F.struct("embedding", "dim")).alias("v")).select("vec_id", "v.*")
    asked = written(in_cells(asked, space).withColumn("bound", F.lit(math.inf)), "op3-queries")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    ranked = lambda found: found.withColumn("rank", rank).where(F.col("rank") <= k)
    if not space:
        return ranked(_search(trees, asked, k, ratio, block)).select("query_id", "rank", "vec_id", "score")
    home = written(ranked(_search(trees, asked, k, ratio, block)), "op3-home")
    bounds = home.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("worst"))
    others = _search(trees, written(visits(asked, bounds, trees, space, ratio), "op3-visits"), k, ratio, block)
    return ranked(home.drop("rank").unionByName(others)).select("query_id", "rank", "vec_id", "score")


def contract(embeddings: DataFrame) -> DataFrame:
    return nearest(embeddings, embeddings.where(F.col("vec_id") % 100 == 0))
