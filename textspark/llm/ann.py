"""Approximate nearest neighbours: NN-descent builds a neighbour graph, greedy search answers queries.

Nodes are distinct vectors, so a vector that a third of all rows share is one node. All steps are
joins and grouped streams over tables; no step needs the vectors in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textspark.llm.common import light_rounds, runs
from textspark.operators.lookup import lookup
from textspark.session import materialise

NEIGHBOURS = 20  # edges kept for each node
REVERSE = 20  # edges into a node that join its neighbourhood in one round, drawn by hash
CHUNK = 256  # nodes compared with each other at the start
STARTS = 2
ROUNDS = 8  # of NN-descent, at most
SETTLED = 0.02  # share of new edges at which it ends
BEAM, EXPAND = 256, 64  # candidates a query keeps, and how many of them it expands at once
SEARCH_ROUNDS = 24
SMALL = 8 << 20  # bytes of vectors that may be broadcast


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector can be compared: no nulls, finite, not zero, of the most common length."""
    v = F.col(vector)
    fine = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.where(F.coalesce(fine, F.lit(False)))
    common = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size(v) == (common["n"] if common else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float32).reshape(len(rows), -1)


def _edges(u: np.ndarray, v: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(score.astype(np.float32))], names=["u", "v", "score"])


def nodes_of(rows: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """Nodes ``node, vec`` (one for each different vector; scaled, as bytes) and rows ``id, node, original``.

    Rows that repeat a key and its vector are one row.
    """
    rows = usable(rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("original")), "original")
    rows = materialise(rows.distinct())
    names = rows.groupBy("original").agg(F.count("*").alias("n"))

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = []
            for x in batch.column(1).to_pylist():
                x = np.array(x, np.float64)
                x /= np.abs(x).max()
                vec.append((x / np.sqrt(x @ x)).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vec, pa.binary())], names=["node", "vec"])

    names = materialise(names.withColumn("node", F.monotonically_increasing_id()))
    nodes = materialise(names.select("node", "original").mapInArrow(scale, "node bigint, vec binary"))
    named = lookup(rows, names, "original", "inner", weight="n", limit=SMALL).select("id", "node", "original")
    return nodes, materialise(named)


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` best different edges of each node; ``old`` where the edge was there before."""
    line = Window.partitionBy("u").orderBy(F.desc("score"), "v")
    one = edges.repartition("u").groupBy("u", "v").agg(F.max("score").alias("score"), F.max("old").alias("old"))
    return one.withColumn("_at", F.row_number().over(line)).where(F.col("_at") <= k).drop("_at")


def first_graph(nodes: DataFrame, k: int, seed: int) -> DataFrame:
    """Neighbours among ``CHUNK`` nodes that are next to each other along random directions."""

    def project(start: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    m = _matrix(batch.column(1))
                    way = np.random.default_rng(seed + start).standard_normal((m.shape[1], 8)).astype(np.float32)
                    code = ((m @ way > 0) << np.arange(8)).sum(1) + 1 / (1 + np.exp(-(m @ way[:, 0])))
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code.astype(np.float64))], names=["node", "vec", "code"])

        return run

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                at = max(0, min(at, batch.num_rows - CHUNK))  # the last chunk reaches back
                part = batch.slice(at, CHUNK)
                name, m = part.column(0).to_numpy(), _matrix(part.column(1))
                s = m @ m.T
                np.fill_diagonal(s, -2)
                top = np.argsort(-s, 1, kind="stable")[:, : min(k, len(name) - 1)]
                yield _edges(np.repeat(name, top.shape[1]), name[top].ravel(), np.take_along_axis(s, top, 1).ravel())

    found = None
    for start in range(STARTS):
        laid = nodes.mapInArrow(project(start), "node bigint, vec binary, code double")
        laid = laid.repartitionByRange("code", "node").sortWithinPartitions("code", "node")
        got = laid.mapInArrow(compare, "u bigint, v bigint, score float")
        found = got if found is None else found.union(got)
    return _best(found.withColumn("old", F.lit(False)), k)


def _join_neighbours(table: pa.Table) -> pa.RecordBatch | None:
    """All pairs of one node's neighbours, of which one is new to it, that beat a neighbour's worst edge."""
    name, old = table["m"].to_numpy(), table["old"].to_numpy(zero_copy_only=False)
    if len(name) < 2 or old.all():
        return None
    worst, m = table["worst"].to_numpy(zero_copy_only=False), _matrix(table["vec"])
    s = m @ m.T
    useful = (s > worst[:, None]) & ~(old[:, None] & old[None, :]) & (name[:, None] != name[None, :])
    i, j = np.nonzero(useful)
    return _edges(name[i], name[j], s[i, j]) if len(i) else None


def neighbour_graph(nodes: DataFrame, k: int = NEIGHBOURS, seed: int = 7) -> DataFrame:
    """``u, v, score``: about the ``k`` nearest neighbours of each node, by NN-descent."""
    graph = materialise(first_graph(nodes, k, seed))
    total = nodes.count() * k
    # A node can be a neighbour of very many, and only adaptive plans split its rows.
    with light_rounds(nodes.sparkSession, adaptive=True):
        for turn in range(ROUNDS):
            worst = graph.groupBy("u").agg(F.min("score").alias("worst"), F.count("*").alias("n"))
            worst = worst.select("u", F.when(F.col("n") < k, -2.0).otherwise(F.col("worst")).cast("float").alias("worst"))
            drawn = Window.partitionBy("v").orderBy("old", F.xxhash64(F.lit(turn), "u", "v"))
            back = graph.withColumn("_at", F.row_number().over(drawn)).where(F.col("_at") <= REVERSE)
            pool = graph.select(F.col("u").alias("c"), F.col("v").alias("m"), "old")
            pool = pool.union(back.select(F.col("v").alias("c"), F.col("u").alias("m"), "old"))
            pool = pool.groupBy("c", "m").agg(F.min("old").alias("old"))
            facts = nodes.join(worst, nodes["node"] == worst["u"], "left")
            facts = facts.select(F.col("node").alias("m"), "vec", F.coalesce("worst", F.lit(-2.0)).cast("float").alias("worst"))
            laid = pool.join(facts, "m").select("c", "m", "old", "worst", "vec").repartition("c").sortWithinPartitions("c")
            new = laid.mapInArrow(runs(_join_neighbours), "u bigint, v bigint, score float")
            before = graph.withColumn("old", F.lit(True))
            graph = materialise(_best(before.union(new.withColumn("old", F.lit(False))), k))
            if graph.where("not old").count() <= SETTLED * total:
                break
    return graph.select("u", "v", "score")


def _score_candidates(table: pa.Table) -> pa.RecordBatch | None:
    """Scores of a query's candidates; its own vector is the row whose node is the query."""
    name, m = table["v"].to_numpy(), _matrix(table["vec"])
    own = name == table["q"].to_numpy()
    if not own.any() or own.all():
        return None
    s = m @ m[own][0]
    name, s = name[~own], s[~own]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(name), table["q"][0].as_py())), pa.array(name), pa.array(s.astype(np.float32))], names=["q", "v", "score"])


def search(nodes: DataFrame, graph: DataFrame, queries: DataFrame, beam: int = BEAM) -> DataFrame:
    """``q, v, score``: the best ``beam`` nodes found for each query node (``q``).

    Starts at the query's own neighbours. A round expands the best unexpanded nodes of every query's beam
    along edges in both directions; it ends when no beam holds an unexpanded node. Only the beam is kept,
    ``beam`` rows a query: the worst score of a full beam never falls, so a node that fell out and is
    scored again falls out again.
    """
    drawn = Window.partitionBy("v").orderBy(F.desc("score"), "u")
    back = graph.withColumn("_at", F.row_number().over(drawn)).where(F.col("_at") <= 2 * NEIGHBOURS)
    ways = materialise(graph.select("u", "v").union(back.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    start = queries.select(F.col("q").alias("u")).join(graph, "u").select(F.col("u").alias("q"), "v", "score")
    line = Window.partitionBy("q").orderBy(F.desc("score"), "v")

    def turned(rows: DataFrame) -> DataFrame:
        """The beam of each query; ``turn`` numbers its unexpanded nodes, best first."""
        best = rows.withColumn("_at", F.row_number().over(line)).where(F.col("_at") <= beam).drop("_at")
        return materialise(best.withColumn("turn", F.when(~F.col("done"), F.row_number().over(Window.partitionBy("q", "done").orderBy(F.desc("score"), "v")))))

    # No node has more rows here than there are queries, or ways.
    with light_rounds(nodes.sparkSession, adaptive=False):
        held = turned(start.withColumn("done", F.lit(False)))
        for _ in range(SEARCH_ROUNDS):
            expands = F.coalesce(F.col("turn") <= EXPAND, F.lit(False))
            front = held.where(expands).select("q", "v")
            if front.isEmpty():
                break
            next_ = front.join(ways.select(F.col("u").alias("v"), F.col("v").alias("w")), "v").select("q", F.col("w").alias("v")).where("q != v").distinct()
            next_ = next_.join(held.select("q", "v"), ["q", "v"], "left_anti")
            next_ = next_.union(front.select("q", F.col("q").alias("v")).distinct())
            laid = next_.join(nodes.withColumnRenamed("node", "v"), "v").select("q", "v", "vec").repartition("q").sortWithinPartitions("q")
            new = laid.mapInArrow(runs(_score_candidates), "q bigint, v bigint, score float").withColumn("done", F.lit(False))
            held = turned(held.select("q", "v", "score", (F.col("done") | expands).alias("done")).union(new))
    return held.select("q", "v", "score")


def _cosine(a: str, b: str) -> Column:
    def dot(x: str | Column, y: str | Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, t: s + t)

    def scaled(x: str) -> Column:
        """``x`` itself, unless its square leaves the range of doubles: then by its largest component."""
        square, most = dot(x, x), F.array_max(F.transform(x, lambda p: F.abs(p)))
        return F.when((square > 1e-200) & (square < 1e200), F.col(x)).otherwise(F.transform(x, lambda p: p / most))

    def cosine(p: Column, q: Column) -> Column:
        return dot(p, q) / (F.sqrt(dot(p, p)) * F.sqrt(dot(q, q)))

    return F.element_at(F.transform(F.array(F.struct(scaled(a).alias("p"), scaled(b).alias("q"))), lambda s: cosine(s["p"], s["q"])), 1)


def nearest(rows: DataFrame, asks: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: about the ``k`` nearest other rows of each row for which ``asks`` holds.

    ``asks`` is a condition on ``id``. Nearness is the cosine in double precision on the original
    vectors, ties to the smaller key. Vectors that are null, zero, hold null or non-finite components,
    or are of another length than most, take no part, neither as query nor as candidate. Rows with
    equal vectors are one node of the graph, and all of them candidates. With fewer candidates, all
    are returned; an empty table gives none. Rows that repeat a key and its vector are one row; rows of one key
    with different vectors each ask and can be found, but not by each other, which may leave them fewer than ``k``.
    """
    nodes, named = nodes_of(rows, key, vector)
    asking = named.where(asks)
    graph = neighbour_graph(nodes)
    found = search(nodes, graph, asking.select(F.col("node").alias("q")).distinct())
    line = Window.partitionBy("q").orderBy(F.desc("score"), "v")
    close = found.withColumn("_at", F.row_number().over(line)).where(F.col("_at") <= 4 * k).select("q", "v")
    close = close.union(asking.select(F.col("node").alias("q"), F.col("node").alias("v")).distinct())
    # Of rows with equal vectors the first k + 1 can rank: one of them may be the query itself.
    first = Window.partitionBy("node").orderBy("id")
    members = named.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= k + 1).select(F.col("node").alias("v"), "id")
    originals = materialise(named.groupBy("node").agg(F.first("original").alias("original")))
    pairs = (
        close.join(originals.select(F.col("node").alias("q"), F.col("original").alias("a")), "q")
        .join(originals.select(F.col("node").alias("v"), F.col("original").alias("b")), "v")
        .select("q", "v", _cosine("a", "b").alias("score"))
    )
    ranked = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    lists = pairs.join(members, "v").withColumnRenamed("id", "vec_id")
    lists = lists.withColumn("_at", F.row_number().over(ranked)).where(F.col("_at") <= k + 1)
    answers = asking.select(F.col("id").alias("query_id"), F.col("node").alias("q")).join(lists, "q").where("query_id != vec_id")
    own = Window.partitionBy("query_id").orderBy("_at")
    answers = answers.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return answers.select("query_id", "rank", "vec_id", "score")
