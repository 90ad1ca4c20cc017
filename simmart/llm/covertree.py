"""Exact inner-product top-k search by dual-tree traversal of cover trees.

Vectors are turned into integers, floor(scale * x), with which all scores are
exact. Queries and data are dealt by place into blocks of a bounded size: to the
nearest of at most CENTRES sampled vectors, and by hash where one has many. A
block of either becomes a cover tree: every node is a vector of the block, its
children lie within the radius of its level and apart from one another by more,
radii shrink from level to level, and it knows the covering radius of all below
it. A block of queries meets the data block of nearest centre first, which gives
each query a floor, and then the blocks whose balls allow a score at the floors.
Where two blocks meet both trees are walked together: a pair of nodes is left out
if the bound that its covering radii allow, <q, p> + r_q |p| + r_p |q| + r_q r_p,
is below the worst kth score, or floor, of the query group. The best k of a block
go on to the best k of all.

Vectors that are null, or hold a null or a component that is not finite, take
no part. Only vectors of equal length have scores. Every row is a candidate but
for those with the query's own id; of equal rows no more than k can matter and
are kept. Rows of one query id are one query, which gets the best k of all its
vectors. Rows with a null id take no part. Scores beyond the range of 64-bit
integers are cut to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from simmart.llm.common import blob, per_batch, prepared, stored

K = 5
SCALE = 256
BLOCK = 4_096  # vectors of a block, on average
CENTRES = 1_024
LEAF, QUERY_LEAF = 64, 8
SLICE = 64  # query blocks, on average, that a data block is sent for
SHRINK = 0.9
SLACK = 1e-9  # for rounding in the bounds
BLOCK_ROW = "dim int, block bigint, ids binary, vectors binary, centre binary, radius double"
SEARCHED = (
    "dim int, asked bigint, floors binary, worst bigint, compared bigint, q_ids binary, best_ids binary, best binary"
)


@dataclass
class Tree:
    """A cover tree in breadth-first order. `order` lists the block's vectors
    so that those below a node stand together, from `begin` to `end`."""

    order: np.ndarray
    centre: np.ndarray  # of each node: a vector
    radius: np.ndarray  # covering all below it
    begin: np.ndarray
    end: np.ndarray
    child: np.ndarray  # first child
    children: np.ndarray  # how many; 0 for a leaf


def build(x: np.ndarray, leaf: int = LEAF) -> Tree:
    """The cover tree of the rows of x."""
    own = np.arange(len(x))
    start = np.sqrt(np.maximum(((x - x[0]) ** 2).sum(axis=1), 0))
    nodes = [[0, float(start.max()), 0, len(x), 0, 0]]
    order, reach = own.copy(), [float(start.max())]
    i = 0
    while i < len(nodes):
        centre, radius, begin, end, _, _ = nodes[i]
        if end - begin > leaf and radius > 0:
            groups = _cover(x, order[begin:end], centre, reach[i] * SHRINK)
            if len(groups) == 1:  # all within the smaller radius: one level down
                reach[i] *= SHRINK
                continue
            nodes[i][4], nodes[i][5] = len(nodes), len(groups)
            for middle, members, far in groups:
                order[begin : begin + len(members)] = members
                nodes.append([middle, far, begin, begin + len(members), 0, 0])
                reach.append(reach[i] * SHRINK)
                begin += len(members)
        i += 1
    columns = [np.array(c) for c in zip(*nodes)]
    return Tree(order, columns[0], columns[1].astype(float), *columns[2:])


def _cover(x: np.ndarray, members: np.ndarray, centre: int, radius: float) -> list[tuple[int, np.ndarray, float]]:
    """Children: the node's own vector, then vectors farther than the radius
    from those before, each with the members it covers."""
    found, left, middle = [], members, centre
    while len(left):
        away = np.sqrt(np.maximum(((x[left] - x[middle]) ** 2).sum(axis=1), 0))
        near = away <= radius
        found.append((middle, left[near], float(away[near].max())))
        left = left[~near]
        if len(left):
            middle = int(left[0])
    return found


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of integers, exactly: in floating point where
    every sum stays below 2**53, else in Python's integers, cut to 64 bits."""
    size = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * a.shape[1]
    if size < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in m.tolist()], object).reshape(m.shape) for m in (a, b)]
    limits = np.iinfo(np.int64)
    found = [[min(max(int(v), limits.min), limits.max) for v in row] for row in whole[0] @ whole[1].T]
    return np.array(found, np.int64).reshape(len(a), len(b))


class Search:
    """Best k candidates of each query of one pair of blocks."""

    def __init__(
        self, queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int,
        tree: Tree, floors: np.ndarray | None = None,
    ) -> None:
        self.q, self.q_ids, self.x, self.ids, self.k = queries, query_ids, data, ids, k
        self.tree, self.q_tree = tree, build(queries, QUERY_LEAF)
        self.norm = np.sqrt((data**2).sum(axis=1))
        self.q_norm = np.sqrt((queries**2).sum(axis=1))
        self.best = np.full((len(queries), k), np.iinfo(np.int64).min)
        self.best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.filled = np.zeros(len(queries), np.int64)
        self.floors = np.full(len(queries), np.iinfo(np.int64).min) if floors is None else floors
        self.compared = 0

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        stack = [(0, np.zeros(1, np.int64))]
        while stack:
            node, others = stack.pop()
            tree = self.q_tree
            if not tree.children[node]:
                self._leaf(node, others)
                continue
            others = self._opened(others)
            for child in range(tree.child[node], tree.child[node] + tree.children[node]):
                bound = self._bounds(child, others)
                stack.append((child, others[bound >= self._worst(child)]))
        return self.best, self.best_id, self.filled

    def _members(self, node: int) -> np.ndarray:
        return self.q_tree.order[self.q_tree.begin[node] : self.q_tree.end[node]]

    def _worst(self, node: int) -> float:
        """The worst kth score, or floor, of a query group; while one has
        neither, none."""
        own = self._members(node)
        kth = np.where(self.filled[own] >= self.k, self.best[own, -1], np.iinfo(np.int64).min)
        worst = int(np.maximum(kth, self.floors[own]).min())
        return float(worst) if worst > np.iinfo(np.int64).min else -np.inf

    def _bounds(self, node: int, others: np.ndarray) -> np.ndarray:
        """What a query below the node and a vector below each other node can
        score at most."""
        q, r = self.q_tree.centre[node], self.q_tree.radius[node]
        p, s = self.tree.centre[others], self.tree.radius[others]
        bound = self.x[p] @ self.q[q] + r * self.norm[p] + s * self.q_norm[q] + r * s
        return bound + SLACK * (np.abs(bound) + (self.norm[p] + s) * (self.q_norm[q] + r))

    def _opened(self, others: np.ndarray) -> np.ndarray:
        """Nodes of the data tree, those with children replaced by them."""
        counts = self.tree.children[others]
        inner = counts > 0
        firsts, counts = self.tree.child[others[inner]], counts[inner]
        steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.concatenate([others[~inner], np.repeat(firsts, counts) + steps])

    def _leaf(self, node: int, others: np.ndarray) -> None:
        """A leaf of queries: the data nodes, best bound first, are opened down
        to leaves, and these compared in batches until no bound is left above
        the worst kth score."""
        while (self.tree.children[others] > 0).any():
            others = self._opened(others)
            others = others[self._bounds(node, others) >= self._worst(node)]
        bound = self._bounds(node, others)
        order = np.argsort(-bound, kind="stable")
        others, bound = others[order], bound[order]
        sizes = np.cumsum(self.tree.end[others] - self.tree.begin[others])
        own, at = self._members(node), 0
        while at < len(others) and bound[at] >= self._worst(node):
            done = sizes[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(sizes, done + 4 * LEAF, side="right")))
            spans = [self.tree.order[b:e] for b, e in zip(self.tree.begin[others[at:upto]], self.tree.end[others[at:upto]])]
            self._compare(own, np.concatenate(spans))
            at = upto

    def _compare(self, own: np.ndarray, members: np.ndarray) -> None:
        score, ids = dot(self.q[own], self.x[members]), self.ids[members]
        self.compared += score.size
        same = self.q_ids[own][:, None] == ids[None]
        every = np.concatenate([self.best[own], score], axis=1)
        every_id = np.concatenate([self.best_id[own], np.broadcast_to(ids, score.shape)], axis=1)
        real = np.concatenate([np.arange(self.k)[None] < self.filled[own][:, None], ~same], axis=1)
        order = np.lexsort([every_id, -every.astype(np.float64), ~real], axis=1)
        if np.abs(every[real]).max(initial=0) >= 2**53:  # floats would tie what differs
            order = np.stack([self._exact_order(*row) for row in zip(every, every_id, real)])
        top = order[:, : self.k]
        self.best[own] = np.take_along_axis(every, top, 1)
        self.best_id[own] = np.take_along_axis(every_id, top, 1)
        self.filled[own] = np.minimum(self.k, np.take_along_axis(real, top, 1).sum(axis=1))

    @staticmethod
    def _exact_order(score: np.ndarray, ids: np.ndarray, real: np.ndarray) -> list[int]:
        return sorted(range(len(score)), key=lambda i: (not real[i], -int(score[i]), int(ids[i])))


def _packed(batch: pa.Table) -> pa.Table:
    """The vectors of a block in one row: ids, numbers, and the ball that holds
    them."""
    rows = [np.frombuffer(v, np.float64) for v in batch.column("vector").to_pylist()]
    x = np.stack(rows)
    centre = x.mean(axis=0)
    radius = float(np.sqrt(np.maximum(((x - centre) ** 2).sum(axis=1), 0)).max())
    return pa.table(
        {
            "dim": batch.column("dim")[:1],
            "block": batch.column("block")[:1],
            "ids": pa.array([blob(batch.column("id").to_numpy())], pa.binary()),
            "vectors": pa.array([blob(x)], pa.binary()),
            "centre": pa.array([blob(centre)], pa.binary()),
            "radius": pa.array([radius]),
        }
    )


def whole(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(id, dim, vector) with the usable vectors as whole numbers."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(1)
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
        cuts = np.cumsum(sizes)
        found = [blob(v) for v in np.split(flat, cuts[:-1])] if len(sizes) else []
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int32()), pa.array(found, pa.binary())], ["id", "dim", "vector"]
        )

    values = F.col(vector).cast("array<double>")
    usable = vectors.select(F.col(key).cast("bigint").alias("id"), values.alias("v"))
    usable = usable.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    usable = usable.where(~F.exists("v", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    return per_batch(usable, run, "id bigint, dim int, vector binary")


def _centres(rows: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Some vectors of each length, chosen by hash, by which blocks are dealt:
    at most CENTRES in all."""
    order = F.xxhash64("vector", "id")
    sample = rows.select("dim", "vector", order.alias("order")).orderBy("order").limit(min(CENTRES, count)).collect()
    found: dict[int, list] = {}
    for r in sample:
        found.setdefault(r.dim, []).append(np.frombuffer(r.vector, np.float64))
    return {dim: np.stack(v) for dim, v in found.items()}


def _blocks(rows: DataFrame, block: int, centres: dict[int, np.ndarray]) -> DataFrame:
    """Blocks by place: vectors go to the nearest centre, and those of one that
    has many are dealt out by hash."""

    def placed(batch: pa.RecordBatch) -> pa.RecordBatch:
        dims, vectors = batch.column(1).to_numpy(), batch.column(2).to_pylist()
        place = np.zeros(len(batch), np.int64)
        for dim in np.unique(dims):
            if (own := centres.get(int(dim))) is not None and dim:
                at = np.flatnonzero(dims == dim)
                x = np.stack([np.frombuffer(vectors[i], np.float64) for i in at])
                place[at] = ((own**2).sum(axis=1)[None] - 2 * x @ own.T).argmin(axis=1)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "place"])

    found = per_batch(rows.select("id", "dim", "vector", "copy"), placed, "id bigint, dim int, vector binary, copy int, place bigint")
    found = stored(found, "placed")
    parts = found.groupBy("dim", "place").agg(F.ceil(F.count("*") / block).alias("parts"))
    found = found.join(F.broadcast(parts), ["dim", "place"])  # a row for each centre
    part = F.pmod(F.xxhash64("id", "vector", "copy"), F.col("parts"))
    found = found.withColumn("block", F.col("place") * F.lit(1 << 32) + part)
    return stored(found.groupBy("dim", "block").applyInArrow(_packed, BLOCK_ROW), "blocks")


def _pairs(data: DataFrame, asked: DataFrame) -> DataFrame:
    """(dim, block, asked, near, bound) of every data block and query block of
    one vector length: the inner product of their centres, and what a query and a
    vector of the two can score at most. Of blocks only their balls meet."""
    queries = asked.select("dim", F.col("block").alias("asked"), F.col("centre").alias("q_centre"), F.col("radius").alias("q_radius"))
    numbered = queries.groupBy("dim").agg(F.collect_list("asked").alias("every"))
    balls = data.select("dim", "block", "centre", "radius").join(F.broadcast(numbered), "dim")
    balls = balls.withColumn("asked", F.explode("every")).drop("every")

    def bounds(batch: pa.RecordBatch) -> pa.RecordBatch:
        near, bound = np.zeros(len(batch)), np.zeros(len(batch))
        c, r, qc, qr = (batch.column(i).to_pylist() for i in range(3, 7))
        for i in range(len(batch)):
            p, q = np.frombuffer(c[i], np.float64), np.frombuffer(qc[i], np.float64)
            near[i] = p @ q
            p, q = np.sqrt(p @ p), np.sqrt(q @ q)
            bound[i] = near[i] + r[i] * q + qr[i] * p + r[i] * qr[i]
            bound[i] += SLACK * (abs(bound[i]) + (p + r[i]) * (q + qr[i]))
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(near), pa.array(bound)], ["dim", "block", "asked", "near", "bound"])

    met = balls.join(queries, ["dim", "asked"]).select("dim", "block", "asked", "centre", "radius", "q_centre", "q_radius")
    return per_batch(met, bounds, "dim int, block bigint, asked bigint, near double, bound double")


def _searched(pairs: DataFrame, data: DataFrame, asked: DataFrame, slices: int, k: int) -> DataFrame:
    """Pairs of blocks (dim, block, asked, floors) searched: the best of each
    query among the data block's vectors, packed, with the number of pairs of
    vectors that were compared. Query blocks, which are small, go to the data
    block, whose tree serves a slice of them."""
    group, columns = ["dim", "block", "slice"], ["dim", "asked", "floors", "q_ids", "q_vectors"]
    queries = asked.select("dim", F.col("block").alias("asked"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    sliced = pairs.withColumn("slice", F.pmod(F.xxhash64("asked"), F.lit(slices)))
    met = sliced.join(queries.hint("shuffle_hash"), ["dim", "asked"]).select("block", "slice", *columns)
    wanted = sliced.select(*(F.col(c).alias(c) for c in group)).distinct()
    held = data.select("dim", "block", "ids", "vectors").join(wanted.hint("merge"), ["dim", "block"])

    def search(block: pa.Table, queries: pa.Table) -> pa.Table:
        rows = []
        if block.num_rows:
            dim = block.column("dim")[0].as_py()
            ids = np.frombuffer(block.column("ids")[0].as_py(), np.int64)
            x = np.frombuffer(block.column("vectors")[0].as_py(), np.float64).reshape(len(ids), dim)
            tree = build(x)
            for _, number, floors, q_ids, q in zip(*(queries.column(c).to_pylist() for c in columns)):
                q_ids = np.frombuffer(q_ids, np.int64)
                q = np.frombuffer(q, np.float64).reshape(len(q_ids), dim)
                found = Search(q, q_ids, x, ids, k, tree, None if floors is None else np.frombuffer(floors, np.int64))
                best, best_id, filled = found.run()
                kth = np.where(filled >= k, best[:, -1], np.iinfo(np.int64).min)
                real = np.arange(k)[None] < filled[:, None]
                rows.append(
                    (dim, number, blob(kth), int(kth.min(initial=np.iinfo(np.int64).max)), found.compared,
                     blob(np.repeat(q_ids, filled)), blob(best_id[real]), blob(best[real]))
                )
        names = [c.split()[0] for c in SEARCHED.split(", ")]
        types = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types))})

    return held.groupBy(*group).cogroup(met.groupBy(*group)).applyInArrow(search, SEARCHED)


def rounds(
    vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = K, scale: float = SCALE, block: int = BLOCK
) -> DataFrame:
    """All pairs of blocks that were searched, in two rounds: each query block
    with the data block of nearest centre first, which gives every query a
    floor; then with those whose bound reaches the block's worst floor."""
    distinct = whole(vectors, key, vector, scale).groupBy("id", "dim", "vector").agg(F.count("*").alias("n"))
    distinct = stored(distinct, "vectors")
    copies = F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))).alias("copy")
    rows = distinct.select("id", "dim", "vector", copies)
    count = -(-rows.count() // block)
    centres = _centres(distinct, count) if count > 1 else {}
    data = _blocks(rows, block, centres)
    asked = _blocks(distinct.where(is_query).select("id", "dim", "vector", F.lit(1).alias("copy")), block, centres)
    slices = max(1, asked.count() // SLICE)
    nearest_first = Window.partitionBy("dim", "asked").orderBy(F.desc("near"), "block")
    pairs = stored(_pairs(data, asked).withColumn("turn", F.row_number().over(nearest_first)), "pairs")
    none = F.lit(None).cast("binary").alias("floors")
    first = pairs.where("turn = 1").select("dim", "block", "asked", none)
    first = stored(_searched(first, data, asked, slices, k), "first")
    rest = pairs.where("turn > 1").join(first.select("dim", "asked", "floors", "worst"), ["dim", "asked"])
    rest = rest.where(F.col("bound") >= F.col("worst")).select("dim", "block", "asked", "floors")
    return first.unionByName(_searched(rest, data, asked, slices, k))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    scale: float = SCALE,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query,
    best score first, ties to the smaller id. is_query is a condition on the
    column `id`; the queries are candidates too, but for their own rows."""
    prepared(vectors.sparkSession)

    def unpacked(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [np.frombuffer(b"".join(c.to_pylist()), np.int64) for c in batch.columns]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    found = rounds(vectors, is_query, key, vector, k, scale, block).select("q_ids", "best_ids", "best")
    scored = per_batch(found, unpacked, "query_id bigint, vec_id bigint, score bigint")
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
