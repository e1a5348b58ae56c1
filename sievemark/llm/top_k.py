"""Exact top-k search by inner product with KD-trees, one for each shard.

Vectors are dealt into shards of bounded size by median splits of a bounded sample, so that a shard is a region of space. In a
shard, rows are split at the median of the widest dimension until leaves are small; every node keeps the tight bounding box of
its rows. The greatest inner product of a query with any point of a box is the sum, over dimensions, of the larger of q*low and
q*high: an upper bound. The search opens nodes best bound first and ends when no bound reaches the k-th best score. A query
first searches the shard it lies in; the k-th score found there is propagated, and the query goes on to just those shards one
of whose BOXES boxes (the upper nodes of their trees) can reach it.

Defined results. A component x counts as floor(256 * x). Vectors that are null, or hold a null or non-finite component, and
rows with a null vec_id take no part. Vectors are compared with those of their own length. Ties go to the smaller vec_id.
Rows that repeat a query's vec_id are the query's own and no candidates of it; other repeated rows are candidates one by one;
a repeated query row is answered as often as it occurs. Fewer candidates than k: all. Other columns are not read.

At scale: shards hold MAX_COMPONENTS numbers at most, whatever the dimension; the sample decides only which rows lie together.
Boxes are compared with the queries in blocks of BOX_NUMBERS numbers, one broadcast at a time. A task holds one shard and its
tree and streams through the queries that reached it, QUERY_BLOCK at most, beyond which the shard is searched by several tasks.
What is shuffled is a query for each shard that it can reach and a shard for each block of queries, never a pair of rows. How
many shards a query can reach depends on the data: boxes of clustered vectors prune, those of independent random components
in many dimensions hardly do.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import process_slots, written

#: Rows of a leaf, numbers of a shard, rows below which a table is not dealt over more shards, queries bounded at once.
LEAF, MAX_COMPONENTS, LEAST_ROWS, BLOCK = 256, 1 << 22, 1024, 256
#: Boxes that a shard is described by, at most about.
BOXES = 16
#: Numbers of the sample that planes are fitted on (in expectation), of the boxes compared at once, and queries that a task takes.
SAMPLE_NUMBERS, BOX_NUMBERS, QUERY_BLOCK = 1 << 22, 1 << 22, 1 << 18
RESULT = "query_row long, query_id long, vec_id long, score long"


class Planes:
    """Median splits of the sampled points of each dimension into about as many regions as asked for."""

    def __init__(self, points: dict[int, np.ndarray], regions: dict[int, int]):
        self.trees = {dim: self._split(p, regions.get(dim, 1)) for dim, p in points.items()}

    @staticmethod
    def _split(points: np.ndarray, regions: int) -> tuple[np.ndarray, ...]:
        axis, value, low, high = [-1], [0], [0], [0]  # an axis of -1: a region
        open_ = [(-len(points), 0, np.arange(len(points)))]
        found = 1
        while open_ and found < regions:
            _, node, rows = heapq.heappop(open_)
            own = points[rows]
            spread = np.quantile(own, 0.9, axis=0) - np.quantile(own, 0.1, axis=0) if len(rows) >= 16 else np.zeros(0)
            if not len(spread) or not spread.max() > 0:
                continue
            a = int(np.argmax(spread))
            cut = np.median(own[:, a])
            left = own[:, a] < cut
            if not left.any():
                left = own[:, a] <= cut
                cut = cut + 0.5
            axis[node], value[node], low[node], high[node] = a, cut, len(axis), len(axis) + 1
            for side in (rows[left], rows[~left]):
                heapq.heappush(open_, (-len(side), len(axis), side))
                axis.append(-1), value.append(0), low.append(0), high.append(0)
            found += 1
        return np.array(axis), np.array(value, float), np.array(low), np.array(high)

    def region(self, dim: int, points: np.ndarray) -> np.ndarray:
        """The region of every point."""
        at = np.zeros(len(points), np.int64)
        if dim not in self.trees:
            return at
        axis, value, low, high = self.trees[dim]
        while (inner := np.flatnonzero(axis[at] >= 0)).size:
            node = at[inner]
            at[inner] = np.where(points[inner, axis[node]] < value[node], low[node], high[node])
        return at


class Tree:
    """KD-tree over the rows of an integer matrix."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        self.points, self.ids = points, ids
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.below: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray | None] = []
        if len(points):
            self._split(np.arange(len(points)))
        self.lows, self.highs = (np.array(x) if x else np.empty((0, points.shape[1])) for x in (self.low, self.high))

    def _split(self, rows: np.ndarray) -> int:
        own = self.points[rows]
        low, high = own.min(0), own.max(0)
        node = len(self.low)
        self.low.append(low)
        self.high.append(high)
        self.below.append(None)
        self.rows.append(None)
        if len(rows) <= LEAF or not len(low) or (low == high).all():
            self.rows[node] = rows
            return node
        axis = int(np.argmax(high - low))
        half = len(rows) // 2
        order = rows[np.argpartition(own[:, axis], half)]
        self.below[node] = (self._split(order[:half]), self._split(order[half:]))
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Greatest possible score of every query (rows) in every node (columns)."""
        return np.maximum(queries, 0) @ self.highs.T + np.minimum(queries, 0) @ self.lows.T

    def frontier(self, most: int) -> list[int]:
        """Nodes that together hold all rows, the first ones of the tree in breadth, about so many."""
        nodes = [0] if self.below else []
        while len(nodes) < most and any(self.below[n] is not None for n in nodes):
            nodes = [c for n in nodes for c in (self.below[n] or (n,))]
        return nodes

    def search(self, query: np.ndarray, own_id: int, bounds: np.ndarray, k: int, reach: float) -> list[tuple[int, int]]:
        """(score, vec_id) of the best k rows whose score is `reach` at least."""
        best: list[tuple[int, int]] = []
        open_nodes = [(-bounds[0], 0)] if len(bounds) else []
        while open_nodes:
            bound, node = heapq.heappop(open_nodes)
            if -bound < reach:
                break
            if self.below[node] is not None:
                for child in self.below[node]:
                    if bounds[child] >= reach:
                        heapq.heappush(open_nodes, (-bounds[child], child))
                continue
            rows = self.rows[node]
            scores = self.points[rows] @ query
            hit = np.flatnonzero((scores >= reach) & (self.ids[rows] != own_id))
            if len(hit) > k:
                hit = hit[np.lexsort((self.ids[rows[hit]], -scores[hit]))[:k]]
            best += [(int(scores[i]), int(self.ids[rows[i]])) for i in hit]
            if len(best) >= k:
                best = sorted(best, key=lambda x: (-x[0], x[1]))[:k]
                reach = max(reach, best[-1][0])
        return sorted(best, key=lambda x: (-x[0], x[1]))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(rows, len(values) // rows if rows else 0)


def _exact(points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where all sums stay below 2**53, for fast products; else as integers."""
    most = max(1, int(np.abs(points).max(initial=0))) * max(1, int(np.abs(queries).max(initial=0))) * max(1, points.shape[1])
    kind = np.float64 if most < 1 << 53 else object if most >= 1 << 62 else np.int64
    return points.astype(kind), queries.astype(kind)


class Search:
    """Searches the rows of one shard for queries."""

    def __init__(self, vectors: pa.Table, k: int):
        self.points, self.k = _matrix(vectors["v"], vectors.num_rows), k
        self.ids, self.most = vectors["vec_id"].to_numpy(), int(np.abs(self.points).max(initial=0))
        self.trees: dict = {}

    def answers(self, queries: pa.Table) -> pa.RecordBatch:
        """query_row, query_id, vec_id, score. queries: row, vec_id, v, reach."""
        asked = _matrix(queries["v"], queries.num_rows)
        kind = _exact(self.most, int(np.abs(asked).max(initial=0)), asked.shape[1])
        if kind not in self.trees:
            self.trees[kind] = Tree(self.points.astype(kind), self.ids)
        tree, asked = self.trees[kind], asked.astype(kind)
        found: list[tuple[int, int, int, int]] = []
        rows, ids, reach = queries["row"].to_pylist(), queries["vec_id"].to_pylist(), queries["reach"].to_pylist()
        for start in range(0, len(rows), BLOCK):
            bounds = tree.bounds(asked[start : start + BLOCK])
            for i in range(start, min(start + BLOCK, len(rows))):
                least = -np.inf if reach[i] is None else reach[i]
                found += [(rows[i], ids[i], vec_id, score) for score, vec_id in tree.search(asked[i], ids[i], bounds[i - start], self.k, least)]
        return pa.RecordBatch.from_arrays([pa.array([x[j] for x in found], pa.int64()) for j in range(4)], ["query_row", "query_id", "vec_id", "score"])


def _exact(a: int, b: int, terms: int) -> type:
    """The kind of number that holds sums of so many products exactly: doubles where all sums stay below 2**53, for fast products; else integers."""
    most = max(1, a) * max(1, b) * max(1, terms)
    return np.float64 if most < 1 << 53 else object if most >= 1 << 62 else np.int64


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id long, v array<long>, of the vectors that take part."""
    whole = F.col(embedding).isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    v = F.transform(embedding, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))
    return vectors.where(F.col(vec_id).isNotNull()).where(F.coalesce(whole, F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))


def _placed(base: DataFrame, sizes: list) -> DataFrame:
    """base with the region that each row lies in, by planes fitted on a sample."""
    numbers = sum(r["n"] * max(1, r["dim"]) for r in sizes)
    share = min(1.0, SAMPLE_NUMBERS / max(1, numbers))
    wanted = {r["dim"]: r["shards"] for r in sizes if r["shards"] > 1}
    points: dict[int, np.ndarray] = {}
    if wanted:
        sample = base.where(F.col("dim").isin(list(wanted)) & (F.pmod(F.xxhash64("row", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)))).select("dim", "v").toArrow()
        of = sample["dim"].to_numpy()
        for dim in set(of.tolist()):
            own = sample.filter(pa.array(of == dim))
            points[dim] = _matrix(own["v"], own.num_rows)
    planes = Planes(points, wanted)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, region = batch.column(3).to_numpy(), np.zeros(batch.num_rows, np.int64)
            for dim in set(dims.tolist()):
                own = np.flatnonzero(dims == dim)
                region[own] = planes.region(dim, _matrix(pa.chunked_array([batch.column(2).take(pa.array(own))]), len(own)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region)], ["row", "vec_id", "v", "dim", "region"])

    return base.select("row", "vec_id", "v", "dim").mapInArrow(place, "row long, vec_id long, v array<long>, dim int, region long")


def _reached(asks: DataFrame, boxes: DataFrame) -> DataFrame:
    """dim, shard, row, vec_id, v, reach: the queries for each shard other than their own one of whose boxes can hold a score that they have to reach."""
    numbers = boxes.agg(F.sum(2 * F.col("dim") + 2)).first()[0] or 0
    blocks = max(1, -(-numbers // BOX_NUMBERS))
    found = []
    for b in range(blocks):
        held = boxes.where(F.pmod(F.xxhash64("dim", "shard"), F.lit(blocks)) == b).select("dim", "shard", "low", "high").toArrow()  # BOX_NUMBERS numbers, in expectation
        sides = {}
        for dim in set(held["dim"].to_pylist()):
            own = held.filter(pa.array(held["dim"].to_numpy() == dim))
            sides[dim] = (own["shard"].to_numpy(), _matrix(own["low"], own.num_rows), _matrix(own["high"], own.num_rows))

        def reach(batches: Iterator[pa.RecordBatch], sides=sides) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims, least, own = batch.column(3).to_numpy(), batch.column(5).to_pylist(), batch.column(4).to_numpy()
                for i, dim in enumerate(dims.tolist()):
                    if dim not in sides:
                        continue
                    shards, low, high = sides[dim]
                    q = _matrix(pa.chunked_array([batch.column(2).slice(i, 1)]), 1)[0]
                    kind = _exact(int(max(np.abs(low).max(initial=0), np.abs(high).max(initial=0))), int(np.abs(q).max(initial=0)), dim)
                    bound = high.astype(kind) @ np.maximum(q, 0).astype(kind) + low.astype(kind) @ np.minimum(q, 0).astype(kind)
                    go = (shards != own[i]) if least[i] is None else (shards != own[i]) & (bound >= least[i])
                    to = np.unique(shards[go])
                    for start in range(0, len(to), 1024):
                        part = to[start : start + 1024]
                        one = batch.slice(i, 1).take(pa.array(np.zeros(len(part), np.int64)))
                        yield pa.RecordBatch.from_arrays([one.column(3), pa.array(part), *(one.column(j) for j in (0, 1, 2, 5))], ["dim", "shard", "row", "vec_id", "v", "reach"])

        found.append(asks.select("row", "vec_id", "v", "dim", "shard", "reach").mapInArrow(reach, "dim int, shard long, row long, vec_id long, v array<long>, reach long"))
    return written(reduce(DataFrame.unionByName, found), "away")


def _across(k: int):
    """Rows of shards (ask false) and after them the queries that came to them, to answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, search = None, [], None
        for batch in batches:
            place = list(zip(*(batch.column(j).to_pylist() for j in range(4)), strict=True))  # dim, shard, block, ask
            start = 0
            while start < len(place):
                end = start
                while end < len(place) and place[end] == place[start]:
                    end += 1
                part = batch.slice(start, end - start)
                if place[start][:3] != at:
                    at, held, search = place[start][:3], [], None
                if not place[start][3]:
                    held.append(part.select(["vec_id", "v"]))
                elif held or search:
                    if search is None:
                        search, held = Search(pa.Table.from_batches(held), k), []
                    yield search.answers(pa.Table.from_batches([part]))
                start = end

    return run


def top_k(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every row whose vec_id is_query holds for. vectors: vec_id long, v array<long>."""
    spark = vectors.sparkSession
    base = written(vectors.withColumn("dim", F.size("v")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    bound = F.greatest(F.lit(1), (F.lit(MAX_COMPONENTS) / F.greatest("dim", F.lit(1))).cast("long"))
    rows = F.least(bound, F.greatest(F.lit(LEAST_ROWS), (F.col("n") / process_slots(spark)).cast("long")))
    sizes = base.groupBy("dim").agg(F.count("*").alias("n")).withColumn("rows", rows).withColumn("shards", F.ceil(F.col("n") / F.col("rows")).cast("long"))
    sizes = written(sizes, "sizes")
    placed = written(_placed(base, sizes.collect()), "placed")
    # a region that holds more than a shard may is dealt over several
    parts = placed.groupBy("dim", "region").agg(F.count("*").alias("n")).join(sizes.select("dim", "rows"), "dim").select("dim", "region", F.ceil(F.col("n") / F.col("rows")).cast("long").alias("parts"))
    number = F.shiftleft(F.col("region"), 32) + F.pmod(F.xxhash64("row"), F.col("parts"))
    dealt = placed.join(written(parts, "parts"), ["dim", "region"]).select("dim", number.alias("shard"), "row", "vec_id", "v", F.coalesce(is_query(F.col("vec_id")), F.lit(False)).alias("asks"))
    dealt = written(dealt, "dealt")

    def within(part: pa.Table) -> pa.Table:
        asked = part.filter(part["asks"])
        search = Search(part, k)
        said = search.answers(asked.append_column("reach", pa.nulls(asked.num_rows, pa.int64())))
        tree = next(iter(search.trees.values()))
        nodes = tree.frontier(BOXES)
        none, n = pa.nulls(len(nodes), pa.int64()), said.num_rows
        box = [pa.array([[int(x) for x in side[i]] for i in nodes], pa.list_(pa.int64())) for side in (tree.lows, tree.highs)]
        place = [pa.array([part["dim"][0].as_py()] * (n + len(nodes)), pa.int32()), pa.array([part["shard"][0].as_py()] * (n + len(nodes)), pa.int64())]
        columns = [pa.concat_arrays([said.column(j), none]) for j in range(4)] + place + [pa.concat_arrays([pa.nulls(n, b.type), b]) for b in box]
        return pa.table(columns, names=["query_row", "query_id", "vec_id", "score", "dim", "shard", "low", "high"])

    home = written(dealt.groupBy("dim", "shard").applyInArrow(within, RESULT + ", dim int, shard long, low array<long>, high array<long>"), "home")
    boxes, home = home.where("low is not null"), home.where("low is null").select("query_row", "query_id", "vec_id", "score")
    reached = home.groupBy("query_row").agg(F.when(F.count("*") >= k, F.min("score")).alias("reach"))
    asks = dealt.where("asks")
    asks = asks.join(reached, asks["row"] == reached["query_row"], "left").drop("query_row")
    away = _reached(asks, boxes)
    blocks = written(away.groupBy("dim", "shard").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("long").alias("blocks")), "blocks")
    away = away.join(blocks, ["dim", "shard"]).withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.col("blocks"))).withColumn("ask", F.lit(True))
    met = dealt.join(blocks, ["dim", "shard"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.withColumn("ask", F.lit(False)).withColumn("reach", F.lit(None).cast("long"))
    columns = ["dim", "shard", "block", "ask", "row", "vec_id", "v", "reach"]
    both = met.select(columns).unionByName(away.select(columns)).repartition(process_slots(spark), "dim", "shard", "block").sortWithinPartitions("dim", "shard", "block", "ask")
    rest = both.mapInArrow(_across(k), RESULT)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return home.unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
