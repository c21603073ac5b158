"""Approximate nearest neighbours by vantage-point trees, one for each shard.

Nearness is the largest inner product. With the largest norm M of all vectors it becomes a distance:
each vector gets one more component so that all norms are M, and then
distance**2 = |q|**2 + M**2 - 2 * product. The first levels of one tree, fit on a bounded sample, deal
all distinct vectors to shards by balls: inside or outside of the median distance from a vantage
point. Each shard has a tree of its own over its vectors. For a query the triangle inequality bounds
its distance to every shard and every leaf from below, and what has bound * factor above the distance of
the k-th best found is passed over. A factor of one searches exactly; a larger one visits less. A query
first searches the shard in which it lies, and then those shards that its k-th best leaves open.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, top_hash

#: Expected distinct vectors of a shard at most: an eighth of all, but not under or over these.
SHARD_ROWS = (2_048, 131_072)
#: Vectors of one length in the sample that the shards' balls are fit on (all are then dealt and indexed).
SAMPLE_ROWS = 8_192
LEAF = 64
#: How much the triangle inequality is relaxed by default; the fewer the dimensions, the less it may be.
FACTOR = 1.35
#: What the report takes for its vectors of 64 components; recall and visits are in the README.
REPORT_FACTOR = 5.0
QUERY_BLOCK = 256
#: Finds a query that are held before the best of them are sorted out.
SETTLE = 4


def _halves(points: np.ndarray, leaf: int):
    """Splits of ``points`` (rows) at the median distance from a vantage point, down to ``leaf`` rows.

    Gives the vantage points, per node the largest distance inside and the least outside, and the
    leaves as (rows, path of (node, side)).
    """
    pivots, radii, leaves = [], [], []
    stack = [(np.arange(len(points)), ())]
    rng = np.random.default_rng(5)
    while stack:
        members, path = stack.pop()
        if len(members) <= leaf:
            leaves.append((members, path))
            continue
        pivot = points[members[rng.integers(len(members))]]
        d = np.sqrt(((points[members] - pivot) ** 2).sum(axis=1))
        order = np.argsort(d, kind="stable")
        half = len(members) // 2
        node = len(pivots)
        pivots.append(pivot)
        radii.append((d[order[half - 1]], d[order[half]]))
        stack.append((members[order[:half]], (*path, (node, 0))))
        stack.append((members[order[half:]], (*path, (node, 1))))
    return np.array(pivots).reshape(-1, points.shape[1]), np.array(radii).reshape(-1, 2), leaves


def _bounds(d: np.ndarray, radii: np.ndarray, paths) -> np.ndarray:
    """Least possible distance of each query to each leaf, from its distances ``d`` to the vantage points."""
    out = np.zeros((len(d), len(paths)))
    far = (d - radii[:, 0], radii[:, 1] - d)  # inside: within the inner radius; outside: beyond the outer
    for i, path in enumerate(paths):
        for node, side in path:
            np.maximum(out[:, i], far[side][:, node], out=out[:, i])
    return out


def lifted(vectors: np.ndarray, top: float) -> np.ndarray:
    """Vectors with the component that makes all squared norms ``top``."""
    return np.concatenate((vectors, np.sqrt(np.maximum(top - (vectors**2).sum(axis=1), 0))[:, None]), axis=1)


def distance(q: np.ndarray, product: np.ndarray, top: float) -> np.ndarray:
    """Distances of queries to lifted points, from their inner products."""
    return np.sqrt(np.maximum((q**2).sum(axis=1)[:, None] + top - 2 * product, 0))


class Balls:
    """The first levels of the tree over all vectors of one length: which shard is whose."""

    def __init__(self, top: float, pivots: np.ndarray, radius: np.ndarray, paths: list[tuple]):
        self.top, self.pivots, self.radius, self.paths = top, pivots, radius, paths

    @classmethod
    def fit(cls, sample: np.ndarray, top: float, shards: int) -> Balls:
        leaf = -(-len(sample) // shards)
        pivots, radii, leaves = _halves(lifted(np.unique(np.asarray(sample, np.float64), axis=0), top), max(leaf, 1))
        return cls(top, pivots, radii.mean(axis=1), [p for _, p in leaves])

    def parts(self) -> tuple:
        """What makes it again, without a class of this package: a broadcast is unpickled where the package may be absent."""
        return self.top, self.pivots, self.radius, self.paths

    def shard(self, vectors: np.ndarray) -> np.ndarray:
        """The ball that each vector lies in."""
        out = np.zeros(len(vectors), np.int32)
        if not len(self.pivots):
            return out
        points = lifted(vectors, self.top)
        outside = distance(points, points @ self.pivots.T, self.top) > self.radius
        for i, path in enumerate(self.paths):
            out[np.all([outside[:, node] == bool(side) for node, side in path], axis=0)] = i
        return out

    def bounds(self, q: np.ndarray) -> np.ndarray:
        if not len(self.pivots):
            return np.zeros((len(q), 1))
        # what the rounding of a distance can take from a bound
        slack = 1e-9 * (1 + np.sqrt(self.top))
        return _bounds(distance(q, q @ self.pivots[:, :-1].T, self.top), np.stack((self.radius, self.radius), axis=1), self.paths) - slack


class VPTree:
    """A tree over distinct vectors, each with the ids of its copies; ``visited`` counts (query, leaf) visits."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, top: float | None = None):
        vectors = np.asarray(vectors, np.float64)
        order = np.lexsort((ids,))
        ids, vectors = ids[order], vectors[order]
        self.points, back = np.unique(vectors, axis=0, return_inverse=True)
        by = np.argsort(back.ravel(), kind="stable")
        self.copies = np.split(ids[by], np.cumsum(np.bincount(back.ravel()))[:-1])
        self.first = np.array([c[0] for c in self.copies])
        self.top = float((self.points**2).sum(axis=1).max()) if top is None else top
        self.pivots, self.radii, leaves = _halves(lifted(self.points, self.top), leaf)
        self.paths = [p for _, p in leaves]
        self.leaves = [m for m, _ in leaves]
        self.visited = 0

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Least possible distance of each query (rows) to each leaf."""
        if not len(self.pivots):
            return np.zeros((len(q), 1))
        return _bounds(distance(q, q @ self.pivots[:, :-1].T, self.top), self.radii, self.paths)

    def search(self, q: np.ndarray, k: int, factor: float = FACTOR, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For each query the k best distinct points (-1: fewer) and their inner products, best first.

        ``within``: a distance for each query beyond which nothing is looked for. The two leaves nearest
        by bound come first; then leaf by leaf all queries that their k-th best does not keep away.
        """
        q = np.asarray(q, np.float64)
        bound = self.bounds(q)
        best = np.full((len(q), k), -1)
        score = np.full((len(q), k), -np.inf)
        tau = np.full(len(q), np.inf) if within is None else within.astype(np.float64)
        done = np.zeros(bound.shape, bool)

        held: list[tuple] = []  # (queries, points, products) that are no worse than the k-th best when they were found

        def visit(leaf, rows):
            self.visited += len(rows)
            done[rows, leaf] = True
            found = q[rows] @ self.points[self.leaves[leaf]].T
            i, j = np.nonzero(found >= score[rows, -1:])
            held.append((rows[i], self.leaves[leaf][j], found[i, j]))

        def settle():
            """The k best of what is known and held; ties to the smaller first id."""
            known = np.nonzero(best >= 0)
            row, point, product = (np.concatenate(x) for x in zip((known[0], best[known], score[known]), *held, strict=True))
            held.clear()
            order = np.lexsort((self.first[point], -product, row))
            row, point, product = row[order], point[order], product[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            at = np.flatnonzero(rank < k)
            best[row[at], rank[at]], score[row[at], rank[at]] = point[at], product[at]
            full = np.flatnonzero(score[:, -1] > -np.inf)
            tau[full] = np.minimum(tau[full], distance(q[full], score[full, -1:], self.top)[:, 0])

        near = np.argsort(bound, axis=1, kind="stable")[:, :2]
        for step in range(near.shape[1]):
            for leaf in np.unique(near[:, step]):
                visit(leaf, np.flatnonzero((near[:, step] == leaf) & (bound[:, leaf] * factor <= tau + 1e-9)))
            settle()
        for leaf in np.argsort(bound.min(axis=0), kind="stable"):
            rows = np.flatnonzero(~done[:, leaf] & (bound[:, leaf] * factor <= tau + 1e-9))
            if len(rows):
                visit(leaf, rows)
            if held and sum(len(x) for x, _, _ in held) > SETTLE * len(q):
                settle()
        if held:
            settle()
        # sums of products in one order, whatever the shape of the blocks was
        score = np.where(best < 0, -np.inf, np.einsum("qd,qkd->qk", q, self.points[np.maximum(best, 0)]))
        return best, score


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec of rows that take part: no null id, null vector, null or non-finite component, or zero vector."""
    v = F.col(vec_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).select(
        F.col(id_col).cast("long").alias("id"), v.alias("vec")
    )


def _blocks(batches, heads: int):
    """Runs of equal head columns: (head values, ids, vectors, further columns) of batches (heads..., id, vec, more...)."""
    for b in batches:
        if not b.num_rows:
            continue
        head = np.array([b.column(i).to_numpy() for i in range(heads)])
        ids = b.column(heads).to_numpy()
        flat = b.column(heads + 1).flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(head[0])
        cuts = np.flatnonzero((np.diff(head, axis=1) != 0).any(axis=0)) + 1
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
            dim = int(head[0, s])
            more = [b.column(i).to_numpy(zero_copy_only=False)[s:e] for i in range(heads + 2, b.num_columns)]
            yield head[:, s].tolist(), ids[s:e], flat[ends[s] - dim : ends[e - 1]].reshape(e - s, dim).astype(np.float64), more


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    factor: float = FACTOR,
    shard_rows: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query, its own row left out.

    Every usable row is indexed; vectors of another length than the query's are no candidates. Ties go
    to the smaller id. A row of ``queries`` is a query whatever its id, and gets a list of its own; its own row is one with
    its id and vector, all other rows are candidates as often as they come, so an id may stand in a list twice. Of equal
    vectors the k + 1 smallest ids go on, which is all that an answer can hold, so copies crowd no shard. Shards hold about ``shard_rows``
    vectors (by default as SHARD_ROWS tells); each builds its tree in its task and streams the queries
    in blocks, so a task holds one shard and one block. Empty tables give empty results.
    """
    spark = vectors.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = usable(vectors, id_col, vec_col)
    # partial group limits run before the exchange, so many copies of one vector are few rows in it
    copy = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    points = cut(rows.withColumn("copy", copy).where(F.col("copy") <= k + 1))
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    # a row for each length of vectors
    lengths = points.where("copy = 1").groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n"), F.max(square).alias("top")).collect()
    u = top_hash(F.lit("balls"), F.col("id").cast("string"))
    balls = {}
    for r in lengths:
        # room for the rounding of squares
        top, size = r["top"] * (1 + 1e-12), shard_rows or min(max(r["n"] // 8, SHARD_ROWS[0]), SHARD_ROWS[1])
        shards = -(-r["n"] // size)
        sample = np.zeros((1, r["dim"]))
        if shards > 1:
            share = min(1.0, SAMPLE_ROWS / r["n"])
            drawn = points.where((F.col("copy") == 1) & (F.size("vec") == r["dim"]) & (u < int(share * 2**52))).orderBy("id").select("vec").collect()
            sample = np.array([x["vec"] for x in drawn], np.float64) if drawn else sample
        balls[r["dim"]] = Balls.fit(sample, top, min(shards, len(sample))).parts()
    shared = spark.sparkContext.broadcast(balls)  # at most 8192 vantage points for each length
    kind = vectors.schema[vec_col].dataType.simpleString()

    def dealt(batches):
        """(dim, id, vec, row) to (dim, shard, id, vec, row)."""
        for b in batches:
            shard = np.zeros(b.num_rows, np.int32)
            at = 0
            for (dim,), ids, vec, _ in _blocks([b], 1):
                shard[at : at + len(ids)] = Balls(*shared.value[dim]).shard(vec) if dim in shared.value else 0
                at += len(ids)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shard), *b.columns[1:]], ["dim", "shard", "id", "vec", "row"])

    def open_shards(batches):
        """(dim, id, vec, row, home, within) to a row for each other shard that the k-th best leaves open."""
        for b in batches:
            take, shards = [], []
            at = 0
            for (dim,), ids, vec, (_, home, within) in _blocks([b], 1):
                bound = Balls(*shared.value[dim]).bounds(vec)
                i, s = np.nonzero((bound * factor <= within[:, None]) & (np.arange(bound.shape[1]) != home[:, None]))
                take.append(i + at)
                shards.append(s)
                at += len(ids)
            i, s = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (take, shards))
            some = b.take(pa.array(i))
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(s.astype(np.int32)), *some.columns[1:4], some.column(5)], ["dim", "shard", "id", "vec", "row", "within"])

    def searched(batches):
        """Rows of (dim, shard, kind, id, vec, row, within), points before queries, to answers and, vec_id null, what each query was left with."""
        key, held, tree = None, [], None

        def answer(dim, shard, ids, vecs, rows, within):
            best, score = tree.search(vecs, k + 1, factor, within)
            out = ([], [], [], [])
            limit = np.full(len(ids), np.inf)
            for i, (q, row) in enumerate(zip(ids.tolist(), rows.tolist(), strict=True)):
                found = []
                for p, s in zip(best[i].tolist(), score[i].tolist(), strict=True):
                    if p >= 0:
                        copies = tree.copies[p][: k + 1].tolist()
                        if q in copies and (tree.points[p] == vecs[i]).all():
                            copies.remove(q)  # the query's own row
                        found += [(-s, c) for c in copies]
                found = sorted(found)[:k]
                for s, c in found:
                    out[0].append(q), out[1].append(c), out[2].append(-s), out[3].append(row)
                if len(found) == k:
                    limit[i] = distance(vecs[i : i + 1], np.array([[-found[-1][0]]]), tree.top)[0, 0]
            m = len(ids)
            return {
                "query_id": np.concatenate((np.array(out[0], np.int64), ids)), "vec_id": out[1] + [None] * m, "score": np.concatenate((np.array(out[2], np.float64), limit)),
                "row": np.concatenate((np.array(out[3], np.int64), rows)), "dim": [None] * len(out[0]) + [dim] * m, "home": [None] * len(out[0]) + [shard] * m, "vec": [None] * len(out[0]) + list(vecs),
            }

        for (dim, shard, is_query), ids, vec, (row, within) in _blocks(batches, 3):
            if (dim, shard) != key:
                key, held, tree = (dim, shard), [], None
            if not is_query:
                held.append((ids, vec))
                continue
            if held:
                tree = VPTree(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]), top=shared.value[dim][0])
                held = []
            for i in range(0, len(ids), QUERY_BLOCK):
                if tree is None:  # a shard without points: the query goes on to others
                    m = len(ids[i : i + QUERY_BLOCK])
                    got = {"query_id": ids[i : i + m], "vec_id": [None] * m, "score": np.full(m, np.inf), "row": row[i : i + m], "dim": [dim] * m, "home": [shard] * m, "vec": list(vec[i : i + m])}
                else:
                    got = answer(dim, shard, ids[i : i + QUERY_BLOCK], vec[i : i + QUERY_BLOCK], row[i : i + QUERY_BLOCK], within[i : i + QUERY_BLOCK])
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in fields], schema=fields)

    fields = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("row", pa.int64()), ("dim", pa.int32()), ("home", pa.int32()), ("vec", pa.list_(pa.float64()))])
    out = "query_id long, vec_id long, score double, row long, dim int, home int, vec array<double>"

    def search(asked: DataFrame) -> DataFrame:
        own = placed.select("dim", "shard", F.lit(0).alias("kind"), "id", "vec", "row", F.lit(0.0).alias("within"))
        both = own.unionByName(asked.select("dim", "shard", F.lit(1).alias("kind"), "id", "vec", "row", "within"))
        return both.repartition(n, "dim", "shard").sortWithinPartitions("dim", "shard", "kind", "id").mapInArrow(searched, out)

    deal = f"dim int, shard int, id long, vec {kind}, row long"
    placed = cut(points.select(F.size("vec").alias("dim"), "id", "vec", F.lit(0).cast("long").alias("row")).mapInArrow(dealt, deal))
    known = F.size("vec").isin(list(balls)) if balls else F.lit(False)
    # queries are told apart by a number that is written before it is used
    asked = cut(usable(queries, id_col, vec_col).where(known).select(F.size("vec").alias("dim"), "id", "vec", F.monotonically_increasing_id().alias("row")))
    first = cut(search(asked.mapInArrow(dealt, deal).withColumn("within", F.lit(float("inf")))))
    left = first.where("vec_id is null").select("dim", F.col("query_id").alias("id"), F.col("vec").cast(kind).alias("vec"), "row", "home", F.col("score").alias("within"))
    second = search(left.mapInArrow(open_shards, f"{deal}, within double"))
    found = first.unionByName(second).where("vec_id is not null").select("query_id", "vec_id", "score", "row")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(embeddings: DataFrame) -> DataFrame:
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    return nearest(embeddings, embeddings.where(F.col("vec_id") % 20 == 0), factor=REPORT_FACTOR)
