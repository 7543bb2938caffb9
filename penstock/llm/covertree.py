"""Exact top-k by inner product with dual cover trees.

Vectors are dealt into blocks: by the nearest of some pivots, which a bounded sample provides, and
beyond the size of a block by a hash, so that any number of equal vectors spreads. A task indexes one
block of data and the queries that meet it, each in a tree of nested nets whose nodes know their
centre and covering radius, and walks both trees together. A pair of nodes is left out when the best
product that centres and radii allow is below the worst k-th score of the node's queries.

The walk has two rounds. First each query meets the blocks of its own pivot. The k-th scores found
there are floors in the second round, in which a group of queries meets only those other blocks that
could still improve one of them, by the same bound on group and block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from penstock.llm import common

PIVOTS = 32
BLOCK_ROWS = 4096
# Queries that one task holds beside a block.
GROUP_ROWS = 256
LEAF = 512
QUERY_LEAF = 128
FAN = 16
NONE = (1 << 63) - 1


@dataclass
class Node:
    """Members are rows of the indexed matrix; a leaf has no children."""

    centre: np.ndarray
    radius: float
    members: np.ndarray
    children: list[Node] = field(default_factory=list)

    @cached_property
    def norm(self) -> float:
        return float(np.sqrt(self.centre @ self.centre))


def cover_tree(points: np.ndarray, members: np.ndarray, leaf: int = LEAF) -> Node:
    """Children's centres are a net of the members at half the covering radius, as far as FAN of them
    reach; each member goes to the nearest. Radii are measured, so bounds hold however far the net
    got. Equal points are never split."""
    own = points[members]
    away = np.linalg.norm(own - own[0], axis=1)
    node = Node(own[0], float(away.max()), members)
    if len(members) <= leaf or node.radius == 0:
        return node
    nearest, least = np.zeros(len(members), dtype=int), away
    n = 1
    while n < FAN and least.max() > node.radius / 2:
        new = np.linalg.norm(own - own[int(least.argmax())], axis=1)
        closer = new < least
        nearest[closer], least = n, np.minimum(least, new)
        n += 1
    parts = [members[nearest == i] for i in range(n)]
    node.children = [cover_tree(points, part, leaf) for part in parts if len(part)]
    return node


class Best:
    """The k best of each query so far; equal scores go by the smaller id."""

    def __init__(self, ids: np.ndarray, floors: np.ndarray, k: int) -> None:
        self.ids, self.floors, self.k = ids, floors, k
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), NONE, dtype=np.int64)

    def worst(self, queries: np.ndarray) -> float:
        return float(np.maximum(self.scores[queries, -1], self.floors[queries]).min())

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        last, floors = self.scores[queries, -1][:, None], self.floors[queries][:, None]
        earlier = ids[None, :] < self.found[queries, -1][:, None]
        wanted = (scores > last) | ((scores == last) & earlier)
        wanted &= (scores >= floors) & (ids[None, :] != self.ids[queries][:, None])
        rows, columns = wanted.any(axis=1), wanted.any(axis=0)
        if not rows.any():
            return
        queries, ids = queries[rows], ids[columns]
        scores, wanted = scores[rows][:, columns], wanted[rows][:, columns]
        scores = np.where(wanted, scores, -np.inf)
        if scores.shape[1] > 4 * self.k:
            # What is below the k-th score of its row cannot come in; ties with it can.
            kth = -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1]
            some = (wanted & (scores >= kth[:, None])).any(axis=0)
            scores, ids, wanted = scores[:, some], ids[some], wanted[:, some]
        every = np.concatenate([self.scores[queries], scores], axis=1)
        found = np.concatenate([self.found[queries], np.where(wanted, ids[None, :], NONE)], axis=1)
        order = np.lexsort((found, -every), axis=-1)[:, : self.k]
        self.scores[queries] = np.take_along_axis(every, order, axis=1)
        self.found[queries] = np.take_along_axis(found, order, axis=1)


def reach(a: Node, b: Node) -> float:
    """No product of a member of one with a member of the other is larger."""
    top = a.centre @ b.centre + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
    return float(top) + 1e-9 * (1 + abs(float(top)))


def walk(queries: np.ndarray, data: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """All of `data` against all of `queries`, by their trees."""
    stack = [(cover_tree(queries, np.arange(len(queries)), QUERY_LEAF), [cover_tree(data, np.arange(len(data)))])]
    while stack:
        mine, others = stack.pop()
        others = sorted(((reach(mine, o), i, o) for i, o in enumerate(others)), reverse=True, key=lambda x: x[:2])
        if mine.children:
            open_ = [c for top, _, o in others if top >= best.worst(mine.members) for c in (o.children or [o])]
            stack += [(child, open_) for child in mine.children]
            continue
        for top, _, other in others:
            if top < best.worst(mine.members):
                break
            if other.children:
                stack.append((mine, other.children))
            else:
                scores = queries[mine.members] @ data[other.members].T
                best.add(mine.members, scores, ids[other.members])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy().reshape(len(flat), -1)


RESULT = "query_id bigint, vec_id bigint, score double"


def _search(queries: pa.Table, data: pa.Table, k: int) -> pa.Table:
    """The best of one block for the queries that meet it."""
    empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    if not queries.num_rows or not data.num_rows:
        return empty
    best = Best(queries["vec_id"].to_numpy(), queries["floor"].to_numpy(), k)
    walk(_matrix(queries["v"]), _matrix(data["v"]), data["vec_id"].to_numpy(), best)
    row, column = np.nonzero(best.found != NONE)
    return pa.table({"query_id": best.ids[row], "vec_id": best.found[row, column], "score": best.scores[row, column]})


def _cell_batches(batches: Iterator[pa.RecordBatch], pivots: list[list[float]]) -> Iterator[pa.RecordBatch]:
    centres = np.array(pivots)
    squares = (centres**2).sum(axis=1)
    for batch in batches:
        if not batch.num_rows:
            continue
        points = _matrix(pa.chunked_array([batch.column("v")]))
        cells = (squares - 2 * points @ centres.T).argmin(axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("v"), pa.array(cells.astype(np.int32))], names=["vec_id", "v", "cell"]
        )


def vectors(table: DataFrame, scale: int = 256) -> DataFrame:
    """`vec_id` and `v`: components as floor(scale * x). Rows without id take no part, nor vectors
    that are null or hold null, infinite or undefined components; shorter vectors end in zeros."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    whole = F.transform(x, lambda e: F.floor(e * scale).cast("double"))
    good = table.where(F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False)))
    plain = good.select(F.col("vec_id").cast("long"), whole.alias("v"))
    size = plain.agg(F.max(F.size("v"))).first()[0] or 1
    padded = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(size) - F.size("v")))
    return plain.select("vec_id", F.when(F.size("v") == size, F.col("v")).otherwise(padded).alias("v"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _balls(rows: DataFrame, *key: str) -> DataFrame:
    """`centre` and `radius` of each group: its mean, and the distance of its farthest member."""
    each = rows.select(*key, F.posexplode("v").alias("at", "x")).groupBy(*key, "at").agg(F.avg("x").alias("x"))
    centres = each.groupBy(*key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("centre")
    )
    gap = F.zip_with("v", "centre", lambda x, y: (x - y) * (x - y))
    away = F.sqrt(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x))
    return rows.join(centres, list(key)).groupBy(*key, "centre").agg(F.max(away).alias("radius"))


def _meet(pairs: DataFrame, queries: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """The search of each block with the queries of the groups paired with it. Groups share a task
    up to `team`s of bounded size; a block is sent to each team that meets it."""
    left = queries.join(pairs.select("group", "block"), "group").select("team", "block", "vec_id", "v", "floor")
    teams = left.select(F.col("team").alias("t"), F.col("block").alias("b")).distinct()
    right = data.join(teams, F.col("block") == F.col("b")).select("t", "b", "vec_id", "v")

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        return _search(a, b, k)

    return left.groupBy("team", "block").cogroup(right.groupBy("t", "b")).applyInArrow(search, RESULT)


def search(
    all_vectors: DataFrame, is_query: Column, k: int = 5, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id` and `score` of the k largest inner products of each
    query with all other rows of `all_vectors` (`vec_id`, `v`), fewer where there are fewer; equal
    scores go by the smaller id. Rows with a query's id are its own and no candidates for it; of
    repeated query rows the smallest vector is asked for. Collected: PIVOTS vectors, and a count for
    each of them."""
    vecs = common.stored(all_vectors, "vectors")
    pivots = [r["v"] for r in vecs.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(PIVOTS).collect()]
    if not pivots:
        return vecs.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    celled = common.stored(
        vecs.mapInArrow(partial(_cell_batches, pivots=pivots), "vec_id bigint, v array<double>, cell int"), "cells"
    )
    asked = celled.where(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "cell")).alias("m"))
    asked = asked.select("vec_id", "m.v", "m.cell")
    counts = {r["cell"]: r["n"] for r in celled.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    asks = {r["cell"]: r["n"] for r in asked.groupBy("cell").agg(F.count("*").alias("n")).collect()}

    def dealt(sizes: dict[int, int], rows: int) -> Column:
        """Number of the cell, and of the part of it by hash, as one integer."""
        shares = [max(1, -(-sizes.get(c, 0) // rows)) for c in range(len(pivots))]
        starts = [sum(shares[:c]) for c in range(len(pivots))]
        share, start = (F.get(F.array(*map(F.lit, x)), F.col("cell")) for x in (shares, starts))
        return (start + F.pmod(F.xxhash64("vec_id"), share)).cast("int")

    data = common.stored(celled.withColumn("block", dealt(counts, block_rows)), "data")
    groups = common.stored(
        asked.withColumn("group", dealt(asks, group_rows)).withColumn("team", F.floor(F.col("group") / PIVOTS)), "queries"
    )
    blocks = data.select("block", "cell").distinct()
    own = groups.select("group", "cell").distinct().join(blocks, "cell")
    first = common.stored(_meet(own, groups.withColumn("floor", F.lit(float("-inf"))), data, k), "near")

    kth = F.when(F.count("*") >= k, F.get(F.sort_array(F.collect_list("score"), asc=False), F.lit(k - 1)))
    floors = first.groupBy("query_id").agg(F.coalesce(kth, F.lit(float("-inf"))).alias("floor"))
    known = groups.join(floors.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").withColumn(
        "floor", F.coalesce("floor", F.lit(float("-inf")))
    )
    known = common.stored(known, "floors")
    worst = known.groupBy("group").agg(F.min("floor").alias("worst"), F.first("cell").alias("own"))
    askers = _balls(known, "group").join(worst, "group").select("group", "worst", "own", F.col("centre").alias("q"), F.col("radius").alias("qr"))
    homes = _balls(data.select("block", "cell", "v"), "block", "cell").select("block", "cell", F.col("centre").alias("d"), F.col("radius").alias("dr"))
    # Written before they meet: a theta join would work out one side anew for each partition of the other.
    askers, homes = common.stored(askers, "askers"), common.stored(homes, "homes")
    norms = [F.sqrt(_dot(F.col(c), F.col(c))) for c in ("q", "d")]
    top = _dot(F.col("q"), F.col("d")) + F.col("qr") * norms[1] + F.col("dr") * norms[0] + F.col("qr") * F.col("dr")
    # The stated queries against all rows, in blocks: groups and blocks, not vectors, are paired.
    other = askers.join(homes, (F.col("cell") != F.col("own")) & (top + F.abs(top) * 1e-9 + 1e-6 >= F.col("worst")))
    pairs = common.stored(other.select("group", "block"), "pairs")
    second = _meet(pairs, known, data, k)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        first.unionByName(second)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))
    )
