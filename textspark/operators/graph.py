"""Word graphs per document, attention diffusion and readout as relational operators.

Nodes are the distinct token ids of a document, keyed ``(doc_id, node)``. Since the document
is part of every key, all documents together form one disjoint union of graphs.
Parallel edges are kept as one row with a multiplicity. Matrices are small literals here;
``textspark.plans.graph_model`` scores wide models.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textspark.functions.numeric import dot, doubles, elu, relu, sigmoid
from textspark.operators.elements import pieces
from textspark.operators.lookup import lookup
from textspark.operators.unnest import unnest
from textspark.session import materialise

EDGE = "struct<src:bigint,dst:bigint,mult:bigint>"


@dataclass(frozen=True)
class Head:
    """One attention head: projection ``w`` (in x out) and source score ``a``.

    The target score of an additive attention cancels in the softmax over the edges into
    one target, so it has no place here.
    """

    w: Sequence[Sequence[float]]
    a: Sequence[float]


CHUNK_TOKENS = 1 << 18  # tokens whose edges are sorted together; a longer document is one by itself


def _starts(doc: np.ndarray, n: int) -> pa.Array:
    """Where the entries of each of ``n`` documents begin, from the document of each entry."""
    return pa.array(np.append(0, np.cumsum(np.bincount(doc, minlength=n))), pa.int32())


def _graphs(lists: pa.ListArray, sizes: np.ndarray, ngram: int) -> list[pa.Array]:
    """``nodes`` and ``edges`` of some documents, counted as sorted numbers."""
    flat, n = lists.flatten(), len(lists)
    coded = flat.dictionary_encode(null_encoding="encode")
    by_id = pc.array_sort_indices(coded.dictionary).to_numpy()
    terms, rank = coded.dictionary.take(pa.array(by_id)), np.empty(len(by_id), np.int64)
    rank[by_id] = np.arange(len(by_id))
    code, doc = rank[coded.indices.to_numpy()], np.repeat(np.arange(n), sizes)
    known, base = len(terms) - terms.null_count, max(len(terms), 1)  # a missing id comes last; it has no edges

    line = (doc * base + code) * max(len(code), 1) + np.arange(len(code))
    line.sort()
    head, at = np.divmod(line, max(len(code), 1))
    first = np.sort(at[np.diff(head, prepend=-1) > 0])
    nodes, owner = flat.take(pa.array(first)), doc[first]

    pairs = [np.empty(0, np.int64)]
    for d in range(1, ngram):
        src, dst = code[:-d], code[d:]
        keep = (doc[:-d] == doc[d:]) & (src != dst) & (src < known) & (dst < known)
        pairs.append(((doc[:-d] * base + src) * base + dst)[keep])
    pair = np.concatenate(pairs)
    pair.sort()
    begin = np.flatnonzero(np.diff(pair, prepend=-1))
    rest, dst = np.divmod(pair[begin], base)
    place, src = np.divmod(rest, base)

    place = np.concatenate([place, owner])
    order = pa.array(np.argsort(place, kind="stable"))
    mult = np.concatenate([np.diff(np.append(begin, len(pair))), np.ones(len(first), np.int64)])
    ends = [pa.concat_arrays([terms.take(pa.array(x)), nodes]).take(order) for x in (src, dst)]
    edges = pa.StructArray.from_arrays([*ends, pa.array(mult).take(order)], ["src", "dst", "mult"])
    missing = lists.is_null()
    return [pa.ListArray.from_arrays(_starts(x, n), values, mask=missing) for x, values in ((owner, nodes), (place, edges))]


def document_graphs(encoded: DataFrame, ngram: int = 4, max_length: int | None = None) -> DataFrame:
    """``(doc_id, nodes, edges)`` in one row per document, without a shuffle.

    ``nodes`` are in order of first occurrence; ``edges``, distinct pairs of tokens at distance below ``ngram``
    with their multiplicity, are in order and end with one self-loop per node.
    """
    ids = F.col("ids") if max_length is None else F.slice("ids", 1, max_length)
    docs = encoded.select("doc_id", ids.cast("array<bigint>").alias("ids"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, lists, sizes in pieces(batch, CHUNK_TOKENS):
                yield pa.RecordBatch.from_arrays([keys, *_graphs(lists, sizes, ngram)], names=["doc_id", "nodes", "edges"])

    return docs.mapInArrow(work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, nodes array<bigint>, edges array<{EDGE}>")


def graph_nodes(graphs: DataFrame) -> DataFrame:
    """``(doc_id, idx, node)``: nodes numbered by first occurrence."""
    return graphs.select("doc_id", F.posexplode_outer("nodes").alias("idx", "node")).where("node is not null")


def graph_edges(graphs: DataFrame) -> DataFrame:
    """``(doc_id, src, dst, mult)`` with self-loops."""
    return unnest(graphs, ["doc_id"], "edges", "src")


def term_hidden(aligned: DataFrame, w: Sequence[Sequence[float]], b: Sequence[float]) -> DataFrame:
    """``(id, h)``: linear layer and ReLU over the vectors of the whole vocabulary."""
    out = [relu(dot(F.col("vec"), doubles(col)) + float(bias)) for col, bias in zip(zip(*w), b)]
    return aligned.select("id", F.array(*out).alias("h"))


def node_features(nodes: DataFrame, hidden: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Attach ``h`` to every ``(doc_id, node)``; ``weights`` may name ``(node, freq)`` for salting."""
    dim = hidden.select(F.col("id").alias("node"), "h")
    if weights is not None:
        dim = materialise(dim.join(weights, "node", "left"))  # measured before it is joined
        return lookup(nodes, dim, "node", "inner", "freq").drop("freq")
    return lookup(nodes, dim, "node", "inner")


CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def by_document(spark: SparkSession) -> Iterator[None]:
    """What runs inside joins rows dealt by ``doc_id`` on keys that contain it, without dealing them again."""
    before = spark.conf.get(CO_PARTITION)
    spark.conf.set(CO_PARTITION, "false")
    try:
        yield
    finally:
        spark.conf.set(CO_PARTITION, before)


def _named(letter: str, n: int) -> list[str]:
    return [f"{letter}{i}" for i in range(n)]


def project(nodes: DataFrame, heads: Sequence[Head]) -> DataFrame:
    """``(doc_id, node, f0, …, el0, …)``: features of all heads one after the other, and a source score per head."""
    feats = [F.array(*[dot(F.col("h"), doubles(col)) for col in zip(*head.w)]) for head in heads]
    wide = nodes.select("doc_id", "node", *[f.alias(f"_{i}") for i, f in enumerate(feats)])
    width = len(heads[0].a)
    flat = [F.get(f"_{i}", F.lit(d)).alias(f"f{i * width + d}") for i in range(len(heads)) for d in range(width)]
    return wide.select("doc_id", "node", *flat, *[dot(F.col(f"_{i}"), doubles(head.a)).alias(f"el{i}") for i, head in enumerate(heads)])


def attention_plan(edges: DataFrame, projected: DataFrame, heads: int) -> DataFrame:
    """``edge_attention`` as a plan, to be run ``by_document``: edges and nodes are dealt once each."""
    scores = projected.select("doc_id", F.col("node").alias("src"), *_named("el", heads)).repartition("doc_id")
    into = Window.partitionBy("doc_id", "dst")
    # Rows unnested from compressed arrays are many more than file sizes suggest, so the planner
    # must not take either side for small.
    scored = edges.repartition("doc_id").hint("merge").join(scores, ["doc_id", "src"])
    raised = scored.select("doc_id", "src", "dst", *[(F.col("mult") * F.exp(F.col(f"el{i}") - F.max(f"el{i}").over(into))).alias(f"e{i}") for i in range(heads)])
    return raised.select("doc_id", "src", "dst", *[(F.col(f"e{i}") / F.sum(f"e{i}").over(into)).alias(f"a{i}") for i in range(heads)])


def edge_attention(edges: DataFrame, projected: DataFrame, heads: int = 1) -> DataFrame:
    """``(doc_id, src, dst, a0, …)``: per head the softmax over all edges into the same target, written.

    A row of multiplicity m carries the attention of its m parallel edges together.
    """
    with by_document(edges.sparkSession):
        return materialise(attention_plan(edges, projected, heads))


def diffusion_step(attention: DataFrame, state: DataFrame, heads: int, width: int, alpha: float) -> DataFrame:
    """``z = alpha * f + (1 - alpha) * A z`` on ``(doc_id, node, z0, …, f0, …)``.

    Every node has one self-loop; along it travels what the node keeps, so a step is one join and one sum.
    """
    own = F.col("src") == F.col("dst")
    sent = attention.hint("merge").join(state.withColumnRenamed("node", "src"), ["doc_id", "src"])
    moved, kept = [], []
    for i in range(heads * width):
        passed = (1 - alpha) * F.col(f"a{i // width}") * F.col(f"z{i}")
        moved.append(F.sum(F.when(own, passed + alpha * F.col(f"f{i}")).otherwise(passed)).alias(f"z{i}"))
        kept.append(F.sum(F.when(own, F.col(f"f{i}")).otherwise(0.0)).alias(f"f{i}"))
    return sent.groupBy("doc_id", F.col("dst").alias("node")).agg(*moved, *kept)


def diffusion_plan(attention: DataFrame, projected: DataFrame, heads: int, width: int, k: int, alpha: float) -> DataFrame:
    """``diffuse`` as a plan, to be run ``by_document``: no step deals a row again."""
    attention = attention.repartition("doc_id")
    feats = _named("f", heads * width)
    state = projected.select("doc_id", "node", *[F.col(f"f{i}").alias(f"z{i}") for i in range(heads * width)], *feats).repartition("doc_id")
    for _ in range(k):
        state = diffusion_step(attention, state, heads, width, alpha)
    return state.drop(*feats)


def diffuse(attention: DataFrame, projected: DataFrame, heads: int, width: int, k: int, alpha: float) -> DataFrame:
    """``(doc_id, node, z0, …)`` after ``k`` diffusion steps from the features, heads one after the other; written."""
    with by_document(attention.sparkSession):
        return materialise(diffusion_plan(attention, projected, heads, width, k, alpha))


def gat_layer(
    nodes: DataFrame, edges: DataFrame, heads: Sequence[Head], k: int = 5, alpha: float = 0.5, last: bool = True
) -> DataFrame:
    """``(doc_id, node, h)``: mean over the heads' diffusions; ELU unless it is the last layer."""
    width, n = len(heads[0].a), len(heads)
    projected = materialise(project(nodes, heads))
    z = diffuse(edge_attention(edges, projected, n), projected, n, width, k, alpha)
    return merge_heads(z, width, n, last)


def merge_heads(z: DataFrame, width: int, n: int, last: bool) -> DataFrame:
    """``(doc_id, node, h)``: the mean of ``n`` heads that lie one after the other."""
    mean = [sum((F.col(f"z{j * width + i}") for j in range(1, n)), F.col(f"z{i}")) / n for i in range(width)]
    merged = z.select("doc_id", "node", F.array(*mean).alias("h"))
    return merged if last else merged.withColumn("h", F.transform("h", elu))


def graph_readout(
    docs: DataFrame, nodes: DataFrame, gate: Sequence[float], bias: float
) -> DataFrame:
    """``(doc_id, readout)``: gated sum of node features; zeros for a document without nodes."""
    width = len(gate)
    gated = nodes.withColumn("s", sigmoid(dot(F.col("h"), doubles(gate)) + float(bias)))
    sums = gated.groupBy("doc_id").agg(
        F.array(*[F.sum(F.get("h", F.lit(i)) * F.col("s")) for i in range(width)]).alias("readout")
    )
    zero = F.array_repeat(F.lit(0.0), width)
    return docs.select("doc_id").join(sums, "doc_id", "left").select(
        "doc_id", F.coalesce("readout", zero).alias("readout")
    )


def linear_head(df: DataFrame, w: Sequence[Sequence[float]], b: Sequence[float], source: str = "readout") -> DataFrame:
    """Add ``logits`` of a linear layer over a vector column."""
    out = [dot(F.col(source), doubles(col)) + float(bias) for col, bias in zip(zip(*w), b)]
    return df.withColumn("logits", F.array(*out))
