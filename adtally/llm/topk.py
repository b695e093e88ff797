"""Exact top-k by inner product: a dual-tree search over cover trees of queries and data.

A cover-tree node has a centre, and a radius that covers its points, so no query of one node has a product above
cq.cd + rq|cd| + rd|cq| + rq rd with a point of another. A pair of nodes whose bound lies below the worst k-th score
of the query node is pruned, and otherwise its children are paired.

The upper level is shared by all tasks: centres come from a bounded sample, every row goes to its nearest one, and
radii and counts of all rows are aggregated per centre. A first round pairs each query node with the data nodes of
the largest bound until they hold k rows; its k-th scores prune the other pairs of nodes. Each remaining pair is a
group that builds its own trees below that and goes through them together. Nodes with many rows are cut into blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adtally.llm.rows import stage

#: Rows that centres are chosen from, most centres, and rows of queries and of data in a block.
SAMPLE, CENTRES, QUERY_BLOCK, DATA_BLOCK = 2048, 256, 2048, 8192
#: Points of a leaf, and most children of a node.
LEAF, FAN = 128, 16

#: Room for rounding where scores are too large for floating point.
ROUNDING = 1e-12


def quantised_rows(embeddings: DataFrame, factor: int = 64) -> DataFrame:
    """vec_id and v: floor(factor * x) of each component, taken as double.

    Rows with a null id, a null vector, or a null or non-finite component take no part; rows that share an id all do.
    """
    value = F.col("embedding")
    sound = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = F.transform(value, lambda x: F.floor(x.cast("double") * factor).cast("long")).alias("v")
    return embeddings.filter(F.col("vec_id").isNotNull() & value.isNotNull() & sound).select("vec_id", v)


def quantised(embeddings: DataFrame, factor: int = 64) -> DataFrame:
    """As ``quantised_rows``, but of rows that share an id only the least vector, for callers that want one per id."""
    return quantised_rows(embeddings, factor).groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(rows, width: int, kind: type = float) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(rows), width), kind)
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def spread_centres(points: np.ndarray, most: int) -> np.ndarray:
    """Indices of centres: each next one is the point farthest from those before, until ``most`` or all are covered."""
    chosen, away = [0], np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < most and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return np.array(chosen)


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each point its nearest centre and the distance."""
    square = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None]
    at = square.argmin(1)
    return at, np.linalg.norm(points - centres[at], axis=1)


class Node(NamedTuple):
    """Points first..last of a tree's order, their centre, its length, the covering radius, and children."""

    first: int
    last: int
    centre: np.ndarray
    length: float
    radius: float
    children: list


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, Node]:
    """Order of the points and root. Children's centres lie half a radius apart, or are the FAN farthest from each other."""
    order = np.arange(len(points))

    def grow(first: int, last: int, centre: np.ndarray) -> Node:
        here = points[order[first:last]]
        away = np.linalg.norm(here - centre, axis=1)
        radius, children = float(away.max(initial=0.0)), []
        if last - first > leaf and radius > 0:
            chosen, gap = [int(away.argmin())], np.linalg.norm(here - here[away.argmin()], axis=1)
            while len(chosen) < FAN and gap.max() > radius / 2:
                chosen.append(int(gap.argmax()))
                gap = np.minimum(gap, np.linalg.norm(here - here[chosen[-1]], axis=1))
            if len(chosen) > 1:
                of, _ = nearest(here, here[chosen])
                by_child = np.argsort(of, kind="stable")
                order[first:last] = order[first:last][by_child]
                ends = first + np.cumsum(np.bincount(of, minlength=len(chosen)))
                start = first
                for number, end in enumerate(ends.tolist()):
                    if end > start:
                        children.append(grow(start, end, here[chosen[number]]))
                    start = end
        if len(children) == 1:
            children = []
        return Node(first, last, centre, float(np.linalg.norm(centre)), radius, children)

    root = grow(0, len(points), points.mean(0) if len(points) else np.zeros(points.shape[1]))
    return order, root


def bound(a: Node, b: Node) -> float:
    """No inner product of points of the two nodes is larger; with room for rounding."""
    top = float(a.centre @ b.centre) + a.radius * b.length + b.radius * a.length + a.radius * b.radius
    return top + 1e-9 * (1 + abs(top))


def search(
    queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, floor: np.ndarray, k: int, whole=None
):
    """The k best of ``data`` for each query with a score of ``floor`` or more: rows of query, id, score.

    ``whole`` has both sides as whole numbers where products are too large for floating point; bounds have room for it.
    """
    q_order, q_root = cover_tree(queries, LEAF)
    d_order, d_root = cover_tree(data, LEAF)
    if whole is not None:
        queries, data = whole
    queries, query_ids, kth = queries[q_order], query_ids[q_order], floor[q_order].astype(float)
    data, ids = data[d_order], ids[d_order]
    kept_q, kept_id, kept_score = (np.zeros(0, np.int64) for _ in range(3))
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)

    def leaves(a: Node, b: Node) -> None:
        scores = queries[a.first:a.last] @ data[b.first:b.last].T
        fits = (scores >= kth[a.first:a.last, None]) & (query_ids[a.first:a.last, None] != ids[None, b.first:b.last])
        for row in np.flatnonzero(fits.any(1)).tolist():
            at = np.flatnonzero(fits[row])
            q = a.first + row
            score = np.concatenate([best[q][0], scores[row, at].astype(np.int64)])
            name = np.concatenate([best[q][1], ids[b.first + at]])
            top = np.lexsort((name, -score))[:k]
            best[q] = (score[top], name[top])
            if len(top) == k:
                kth[q] = max(kth[q], float(score[top[-1]]) * (1 if whole is None else 1 - np.sign(score[top[-1]]) * ROUNDING))

    pairs = [(bound(q_root, d_root), q_root, d_root)]
    while pairs:
        top, a, b = pairs.pop()
        if top < kth[a.first:a.last].min():
            continue
        if not a.children and not b.children:
            leaves(a, b)
            continue
        split = [(x, y) for x in (a.children or [a]) for y in (b.children or [b])]
        pairs += sorted(((bound(x, y), x, y) for x, y in split), key=lambda pair: pair[0])
    kept_q = np.concatenate([np.full(len(s), query_ids[q]) for q, (s, _) in enumerate(best)] or [kept_q])
    kept_id = np.concatenate([n for _, n in best] or [kept_id])
    kept_score = np.concatenate([s for s, _ in best] or [kept_score])
    return kept_q, kept_id, kept_score


def _assigned(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """``vectors`` with their nearest centre, ``node``, and the distance, ``away``."""
    names = [*vectors.columns, "node", "away"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, away = nearest(matrix(batch.column("v").to_pylist(), centres.shape[1]), centres)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at, pa.int32()), pa.array(away, pa.float64())], names=names
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
    return vectors.mapInArrow(run, f"{fields}, node int, away double")


def _block(blocks: list[int]) -> Column:
    counts = F.array(*[F.lit(n) for n in blocks])
    return F.pmod(F.xxhash64("vec_id", "row"), F.element_at(counts, F.col("node") + 1)).cast("int")


def _cells(rows: DataFrame, pairs: DataFrame, side: str, other: str) -> DataFrame:
    """Each row once for every block of the nodes that its own node is paired with.

    ``pairs`` has q_node, d_node and the blocks of both: CENTRES squared rows at most, whatever the table.
    """
    partner = pairs.select(F.col(f"{side}_node").alias("node"), f"{other}_node", f"{other}_blocks")
    met = rows.join(F.broadcast(partner), "node").withColumn(
        f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
    )
    return met.select(
        *[c for c in rows.columns if c not in ("node", "block", "away")],
        F.col("node").alias(f"{side}_node"), F.col("block").alias(f"{side}_block"), f"{other}_node", f"{other}_block",
    )


class Level(NamedTuple):
    """What the driver knows of the nodes of one side: rows, radius and blocks of each."""

    counts: list[int]
    radii: list[float]
    blocks: list[int]


def _level(rows: DataFrame, centres: int, block: int) -> Level:
    counts, radii = [0] * centres, [0.0] * centres
    for r in rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect():
        counts[r["node"]], radii[r["node"]] = r["n"], r["radius"]
    return Level(counts, radii, [max(1, -(-n // block)) for n in counts])


def _searched(
    queries: DataFrame, data: DataFrame, pairs: list[tuple[int, int]], q: Level, d: Level, width: int, k: int, exact: bool
):
    """query_id, vec_id, score of the pairs of nodes; each query's best in each block."""
    held = queries.sparkSession.createDataFrame(
        [(n, m, q.blocks[n], d.blocks[m]) for n, m in pairs], "q_node int, d_node int, q_blocks int, d_blocks int"
    )
    key = ["q_node", "q_block", "d_node", "d_block"]
    left = _cells(queries, held, "q", "d").groupBy(*key)
    right = _cells(data, held, "d", "q").groupBy(*key)

    def run(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        found = ([], [], [])
        if len(mine) and len(theirs):
            whole = tuple(matrix(side["v"], width, np.int64) for side in (mine, theirs)) if exact else None
            found = search(
                matrix(mine["v"], width), mine["vec_id"].to_numpy(), matrix(theirs["v"], width),
                theirs["vec_id"].to_numpy(), mine["floor"].to_numpy(), k, whole,
            )
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found, strict=True)), dtype="int64")

    return left.cogroup(right).applyInPandas(run, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, query_block: int = QUERY_BLOCK, data_block: int = DATA_BLOCK
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of each query with rows of another id.

    Both have vec_id (long) and v (array of long); ties go to the smaller vec_id; fewer than k rows give fewer. Rows that
    share an id are candidates each, but not for each other; queries that share one have k products together.
    Shorter vectors count as ending in zeros. Equal vectors are separate rows. Without queries or other rows there are
    no rows. Scores are floating-point products while the longest vectors show that none reaches 2**53, else products of
    whole numbers; where one might reach 2**62, it fails.

    A data row goes to each block of queries whose node is paired with its own. Bounds that prune nothing leave all
    pairs of blocks to compare, which is what an exact search then costs.
    """
    spark = vectors.sparkSession
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    row = F.monotonically_increasing_id().alias("row")  # fixed by the stage; rows of one id are dealt by it
    data = stage(vectors.select("vec_id", "v", row), "topk-data")
    wanted = stage(queries.select("vec_id", "v", row), "topk-queries")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    known = F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("n"), F.max(F.sqrt(square)).alias("length")
    size, asked = data.agg(*known).first(), wanted.agg(*known).first()
    if not size["n"] or not asked["n"]:
        return none
    largest = size["length"] * asked["length"] * (1 + ROUNDING)
    if largest >= 2.0**62:
        raise ValueError(f"inner products may reach {largest:.3g}, which whole numbers of 64 bits don't hold for sure")
    exact = largest >= 2.0**53
    width = max(1, size["width"], asked["width"])
    sample = [r["v"] for r in data.orderBy(F.xxhash64("vec_id", "row"), "vec_id", "row").limit(SAMPLE).select("v").collect()]
    points = matrix(sample, width)
    chosen = points[spread_centres(points, min(CENTRES, -(-size["n"] // data_block)))]
    for_queries = points[spread_centres(points, min(CENTRES, -(-asked["n"] // query_block)))]
    data = stage(_assigned(data, chosen), "topk-data-nodes")
    wanted = stage(_assigned(wanted, for_queries), "topk-query-nodes")
    d, q = _level(data, len(chosen), data_block), _level(wanted, len(for_queries), query_block)
    data, wanted = data.withColumn("block", _block(d.blocks)), wanted.withColumn("block", _block(q.blocks))

    def node(level: Level, centres: np.ndarray, n: int) -> Node:
        return Node(0, level.counts[n], centres[n], float(np.linalg.norm(centres[n])), level.radii[n], [])

    bounds = {
        (n, m): bound(node(q, for_queries, n), node(d, chosen, m))
        for n in range(len(q.counts)) if q.counts[n] for m in range(len(d.counts)) if d.counts[m]
    }
    first = []
    for n in sorted({n for n, _ in bounds}):
        held = 0
        for m in sorted((m for n2, m in bounds if n2 == n), key=lambda m: -bounds[n, m]):
            if held <= k:  # one more than k, as a query's own row doesn't count
                first.append((n, m))
                held += d.counts[m]
    lowest = F.lit(float("-inf"))
    near = stage(_best(_searched(wanted.withColumn("floor", lowest), data, first, q, d, width, k, exact), k), "topk-first")
    worst = near.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), (
        F.col("score").cast("double") - (F.abs(F.col("score").cast("double")) * ROUNDING if exact else F.lit(0.0))
    ).alias("floor"))
    known = wanted.join(worst, "vec_id", "left").withColumn("floor", F.coalesce("floor", lowest))
    floors = {r["node"]: r["floor"] for r in known.groupBy("node").agg(F.min("floor").alias("floor")).collect()}
    rest = [p for p in bounds if p not in set(first) and bounds[p] >= floors[p[0]]]
    found = near.select("query_id", "vec_id", "score")
    if rest:
        found = found.union(_searched(known, data, rest, q, d, width, k, exact))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)


OP2_SQL = """
WITH vectors AS (
    SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
    FROM vectors q JOIN vectors d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
