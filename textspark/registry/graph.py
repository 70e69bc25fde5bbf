"""Queries over word graphs, diffusion, readout and word vectors.

Large results are summed up per document, so that every node and edge counts in the check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.operators import graph as ops
from textspark.operators.graph import Head
from textspark.operators.vocab import encode
from textspark.plans.graph_model import GraphWeights, graph_attention, graph_diffusion, graph_layer, graph_logits, graph_readouts, hashed_hidden
from textspark.registry import sql
from textspark.registry.features import encoded_sql, raw_tokens, raw_vocab, rounded, vocabulary
from textspark.session import materialise, spread
from textspark.sources.tables import table
from textspark.sources.wordvec import align_vectors, coverage, vector_dim

WIDTH, NGRAM, ALPHA, STEPS = 4, 4, 0.5, 3
WEIGHTS = GraphWeights.start(WIDTH, WIDTH, num_layers=3, num_heads=2, seed=7)
CLASSIFIER = [[0.3, -0.2, 0.1], [-0.1, 0.4, 0.2], [0.2, 0.1, -0.3], [-0.4, 0.2, 0.3]]
CLASSIFIER_BIAS = [0.01, -0.02, 0.03]
INPUT = [[((i * 7 + j * 3) % 11 - 5) / 20 for j in range(WIDTH)] for i in range(64)]
INPUT_BIAS = [0.05, -0.05, 0.1, 0.0]


def _corpus(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Vocabulary and encoded documents, whole texts."""
    tokens = raw_tokens(spark, sf)
    vocab = raw_vocab(tokens)
    return vocab, spread(materialise(encode(tokens, vocab)), "doc_id")


def _input(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Encoded documents, and hashed features of the vocabulary."""
    vocab, docs = _corpus(spark, sf)
    return docs, materialise(hashed_hidden(vocab, WIDTH))


def _weights(vocab: DataFrame) -> DataFrame:
    """How often each term stands in the corpus, which bounds how many nodes look it up."""
    return vocab.select(F.col("id").alias("node"), "freq")


def _nodes(spark, sf):
    return ops.graph_nodes(ops.document_graphs(_corpus(spark, sf)[1], NGRAM)).select(
        "doc_id", F.col("idx").cast("bigint").alias("idx"), "node"
    )


def _edges(spark, sf):
    edges = ops.graph_edges(ops.document_graphs(_corpus(spark, sf)[1], NGRAM))
    return edges.groupBy("doc_id").agg(
        F.count("*").alias("edges"),
        F.sum("mult").alias("parallel"),
        F.sum(F.col("mult") * (F.col("src") * 31 + F.col("dst"))).alias("checksum"),
    )


def _summed(df: DataFrame, source: str, keys: list[str], width: int = WIDTH) -> DataFrame:
    """Per key the sum of every component and of all squares."""
    parts = [F.get(source, F.lit(i)) for i in range(width)]
    squares = sum((p * p for p in parts), F.lit(0.0))
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[rounded(F.sum(p)).alias(f"s{i}") for i, p in enumerate(parts)],
        rounded(F.sum(squares)).alias("sq"),
    )


def _vectors(spark, sf, vocab) -> DataFrame:
    """Word vectors for the terms whose id, less the two reserved ones, names an embedding."""
    given = table(spark, sf, "embeddings").select(
        (F.col("vec_id") + 2).alias("id"), F.col("embedding").cast("array<double>").alias("vec")
    )
    return vocab.select("term", "id").join(given, "id").select("term", "vec")


def _aligned(spark, sf):
    vocab = raw_vocab(raw_tokens(spark, sf))
    vectors = _vectors(spark, sf, vocab)
    return align_vectors(vocab, vectors, vector_dim(vectors, 200))


def _wordvec_lookup(spark, sf):
    aligned = _aligned(spark, sf)
    return aligned.select(
        "term",
        "id",
        "covered",
        *[rounded(F.get("vec", F.lit(i))).alias(f"v{i}") for i in (0, 63)],
        rounded(F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x)).alias("total"),
    )


def _wordvec_coverage(spark, sf):
    return coverage(_aligned(spark, sf)).withColumn("coverage", rounded(F.col("coverage")))


def _node_features(spark, sf):
    vocab, docs = _corpus(spark, sf)
    vectors = _vectors(spark, sf, vocab)
    hidden = materialise(ops.term_hidden(align_vectors(vocab, vectors, vector_dim(vectors, 200)), INPUT, INPUT_BIAS))
    nodes = ops.graph_nodes(ops.document_graphs(docs, NGRAM))
    return _summed(ops.node_features(nodes, hidden, _weights(vocab)), "h", ["doc_id"])


def _attention(spark, sf):
    docs, hidden = _input(spark, sf)
    heads = WEIGHTS.layers[0]
    attention = graph_attention(docs, hidden, heads, NGRAM)

    def head(i: int) -> Column:
        a = F.col(f"a{i}")
        return F.struct(
            F.lit(i).alias("head"), F.count("*").alias("edges"), rounded(F.sum(a)).alias("total"),
            rounded(F.sum(a * a)).alias("squares"), rounded(F.max(a)).alias("largest"),
        )

    found = attention.groupBy("doc_id").agg(F.array(*[head(i) for i in range(len(heads))]).alias("heads"))
    return found.select("doc_id", F.inline("heads"))


def _diffusion(k: int):
    def query(spark, sf):
        docs, hidden = _input(spark, sf)
        heads = WEIGHTS.layers[0]
        z = graph_diffusion(docs, hidden, heads, k, ALPHA, NGRAM)
        by_head = [
            F.struct(F.lit(h).alias("head"), F.array(*[f"z{h * WIDTH + i}" for i in range(WIDTH)]).alias("z"))
            for h in range(len(heads))
        ]
        return _summed(z.select("doc_id", F.inline(F.array(*by_head))), "z", ["doc_id", "head"])

    return query


def _gat_layer(spark, sf):
    docs, hidden = _input(spark, sf)
    return _summed(graph_layer(docs, hidden, WEIGHTS.layers[0], STEPS, ALPHA, False, NGRAM), "h", ["doc_id"])


def _graph_readout(spark, sf):
    vocab, docs = _corpus(spark, sf)
    hidden = materialise(hashed_hidden(vocab, WIDTH))
    nodes = ops.node_features(ops.graph_nodes(ops.document_graphs(docs, NGRAM)), hidden, _weights(vocab))
    out = ops.graph_readout(docs, nodes, WEIGHTS.gate, 0.1)
    return out.select("doc_id", *[rounded(F.get("readout", F.lit(i))).alias(f"r{i}") for i in range(WIDTH)])


def _stack(spark, sf) -> DataFrame:
    vocab, docs = _corpus(spark, sf)
    return graph_readouts(docs, hashed_hidden(vocab, WIDTH), WEIGHTS, STEPS, ALPHA, NGRAM)


def _gat_stack(spark, sf):
    return _stack(spark, sf).select(
        "doc_id", *[rounded(F.get("readout", F.lit(i))).alias(f"r{i}") for i in range(WIDTH)]
    )


def _graph_logits(spark, sf):
    scored = graph_logits(_stack(spark, sf), CLASSIFIER, CLASSIFIER_BIAS)
    return scored.select(
        "doc_id", *[rounded(F.get("logits", F.lit(i))).alias(f"z{i}") for i in range(3)], "pred"
    )


QUERIES = {
    "graph_nodes": _nodes,
    "graph_edges": _edges,
    "wordvec_lookup": _wordvec_lookup,
    "wordvec_coverage": _wordvec_coverage,
    "node_features": _node_features,
    "edge_attention": _attention,
    "diffusion_step": _diffusion(1),
    "diffusion_k": _diffusion(STEPS),
    "gat_layer": _gat_layer,
    "graph_readout": _graph_readout,
    "gat_stack": _gat_stack,
    "graph_logits": _graph_logits,
}

_GRAPH = f"""WITH {encoded_sql()},
    node AS (SELECT doc_id, id AS node, min(pos) AS first FROM enc GROUP BY doc_id, id),
    near AS (SELECT doc_id, id AS src, lead(id, 1) OVER w AS d1, lead(id, 2) OVER w AS d2, lead(id, 3) OVER w AS d3
             FROM enc WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    edge AS (SELECT doc_id, src, dst, count(*) AS mult FROM (
               SELECT doc_id, src, d1 AS dst FROM near UNION ALL SELECT doc_id, src, d2 FROM near
               UNION ALL SELECT doc_id, src, d3 FROM near) WHERE src <> dst GROUP BY ALL
             UNION ALL SELECT doc_id, node, node, 1 FROM node)"""


def _hashed(d: int) -> str:
    return "greatest(" + sql.normal(f"'h/' || CAST(id AS VARCHAR) || '/{d}'") + ", 0.0)"


_HIDDEN = "hid AS (SELECT id, " + ", ".join(f"{_hashed(d)} AS h{d}" for d in range(WIDTH)) + " FROM vocab)"
_INPUT_NODES = (
    "n0 AS (SELECT doc_id, node, " + ", ".join(f"h{d}" for d in range(WIDTH)) + " FROM node JOIN hid ON id = node)"
)
_START = f"{_GRAPH}, {_HIDDEN}, {_INPUT_NODES}"


def _linear(xs: list[str], w, b=None) -> list[str]:
    """Expressions of a linear layer over named columns."""
    out = []
    for j in range(len(w[0])):
        terms = " + ".join(f"{x} * ({w[i][j]!r})" for i, x in enumerate(xs))
        out.append(terms if b is None else f"{terms} + ({b[j]!r})")
    return out


def _cols(prefix: str, width: int = WIDTH) -> list[str]:
    return [f"{prefix}{i}" for i in range(width)]


def head_sql(name: str, nodes: str, head: Head, k: int) -> str:
    """CTEs ``{name}f`` (features), ``{name}a`` (attention), ``{name}z0`` … ``{name}z{k}``."""
    feats = ", ".join(f"{e} AS f{i}" for i, e in enumerate(_linear(_cols("h"), head.w)))
    el = " + ".join(f"f{i} * ({a!r})" for i, a in enumerate(head.a))
    ctes = [
        f"{name}f AS (SELECT doc_id, node, {', '.join(_cols('f'))}, {el} AS el FROM (SELECT doc_id, node, {feats} FROM {nodes}))",
        f"""{name}e AS (SELECT e.doc_id, src, dst, mult * exp(el - max(el) OVER (PARTITION BY e.doc_id, dst)) AS e
            FROM edge e JOIN {name}f f ON f.doc_id = e.doc_id AND f.node = e.src)""",
        f"{name}a AS (SELECT doc_id, src, dst, e / sum(e) OVER (PARTITION BY doc_id, dst) AS a FROM {name}e)",
        f"{name}z0 AS (SELECT doc_id, node, {', '.join(f'f{i} AS z{i}' for i in range(WIDTH))} FROM {name}f)",
    ]
    for t in range(1, k + 1):
        sums = ", ".join(f"sum(a * z{i}) AS m{i}" for i in range(WIDTH))
        mixed = ", ".join(f"{ALPHA} * f{i} + {1 - ALPHA} * m{i} AS z{i}" for i in range(WIDTH))
        ctes.append(
            f"""{name}z{t} AS (SELECT doc_id, node, {mixed} FROM {name}f JOIN (
              SELECT g.doc_id, dst AS node, {sums} FROM {name}a g
              JOIN {name}z{t - 1} z ON z.doc_id = g.doc_id AND z.node = g.src GROUP BY g.doc_id, dst)
              USING (doc_id, node))"""
        )
    return ", ".join(ctes)


def layer_sql(name: str, nodes: str, heads, k: int, last: bool) -> str:
    """CTE ``{name}(doc_id, node, h0 …)`` and all it needs."""
    ctes = [head_sql(f"{name}_{i}", nodes, head, k) for i, head in enumerate(heads)]
    every = " UNION ALL ".join(f"SELECT * FROM {name}_{i}z{k}" for i in range(len(heads)))
    elu = "{x}" if last else "CASE WHEN {x} > 0 THEN {x} ELSE exp({x}) - 1 END"
    means = ", ".join(f"{elu.format(x=f'avg(z{i})')} AS h{i}" for i in range(WIDTH))
    return ", ".join(ctes) + f", {name} AS (SELECT doc_id, node, {means} FROM ({every}) GROUP BY doc_id, node)"


def _sums(prefix: str) -> str:
    parts = [f"{sql.rounded(f'sum({prefix}{i})')} AS s{i}" for i in range(WIDTH)]
    squares = " + ".join(f"{prefix}{i} * {prefix}{i}" for i in range(WIDTH))
    return ", ".join(["count(*) AS n", *parts, f"{sql.rounded(f'sum({squares})')} AS sq"])


def _heads_sql(k: int) -> str:
    heads = WEIGHTS.layers[0]
    ctes = ", ".join(head_sql(f"x{i}", "n0", head, k) for i, head in enumerate(heads))
    every = " UNION ALL ".join(f"SELECT {i} AS head, * FROM x{i}z{k}" for i in range(len(heads)))
    return f"{_START}, {ctes} SELECT doc_id, head, {_sums('z')} FROM ({every}) GROUP BY doc_id, head"


def _attention_sql() -> str:
    heads = WEIGHTS.layers[0]
    ctes = ", ".join(head_sql(f"x{i}", "n0", head, 0) for i, head in enumerate(heads))
    every = " UNION ALL ".join(f"SELECT {i} AS head, * FROM x{i}a" for i in range(len(heads)))
    return f"""{_START}, {ctes} SELECT doc_id, head, count(*) AS edges, {sql.rounded('sum(a)')} AS total,
        {sql.rounded('sum(a * a)')} AS squares, {sql.rounded('max(a)')} AS largest
        FROM ({every}) GROUP BY doc_id, head"""


def _readout_sql(nodes: str, bias: float) -> str:
    """CTE ``rd(doc_id, r0 …)``, zeros for documents without nodes."""
    gate = " + ".join(f"h{i} * ({g!r})" for i, g in enumerate(WEIGHTS.gate)) + f" + ({bias!r})"
    sums = ", ".join(f"coalesce(sum(h{i} / (1 + exp(-({gate})))), 0) AS r{i}" for i in range(WIDTH))
    return f"rd AS (SELECT d.doc_id, {sums} FROM documents d LEFT JOIN {nodes} USING (doc_id) GROUP BY d.doc_id)"


def _stack_sql() -> str:
    ctes, nodes = [], "n0"
    for at, heads in enumerate(WEIGHTS.layers):
        name = f"l{at}"
        ctes.append(layer_sql(name, nodes, heads, STEPS, at == len(WEIGHTS.layers) - 1))
        nodes = name
    return f"{_START}, {', '.join(ctes)}, {_readout_sql(nodes, WEIGHTS.gate_bias)}"


_ROUNDED_READOUT = ", ".join(f"{sql.rounded(f'r{i}')} AS r{i}" for i in range(WIDTH))
_LOGITS = _linear(_cols("r"), CLASSIFIER, CLASSIFIER_BIAS)

_ALIGNED = f"""WITH {vocabulary(1)},
    dims AS (SELECT unnest(range(64)) AS i),
    vec AS (SELECT term, id, e.vec_id IS NOT NULL AS covered, i,
              CASE WHEN e.vec_id IS NOT NULL THEN CAST(e.embedding[i + 1] AS DOUBLE)
                   WHEN id = 0 THEN 0.0
                   ELSE {sql.normal("term || '/' || CAST(i AS VARCHAR)")} * 0.1 END AS x
            FROM vocab CROSS JOIN dims LEFT JOIN embeddings e ON e.vec_id = id - 2 AND id >= 2)"""
_LAYER = ", ".join(
    f"greatest(sum(x * CASE i {' '.join(f'WHEN {i} THEN {INPUT[i][j]!r}' for i in range(64))} END)"
    f" + ({INPUT_BIAS[j]!r}), 0.0) AS h{j}"
    for j in range(WIDTH)
)

ORACLES = {
    "graph_nodes": f"""{_GRAPH} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY first) - 1 AS idx, node
        FROM node""",
    "graph_edges": f"""{_GRAPH} SELECT doc_id, count(*) AS edges, CAST(sum(mult) AS BIGINT) AS parallel,
        CAST(sum(mult * (src * 31 + dst)) AS BIGINT) AS checksum FROM edge GROUP BY doc_id""",
    "wordvec_lookup": f"""{_ALIGNED} SELECT term, id, covered, {sql.rounded('max(CASE WHEN i = 0 THEN x END)')} AS v0,
        {sql.rounded('max(CASE WHEN i = 63 THEN x END)')} AS v63, {sql.rounded('sum(x ORDER BY i)')} AS total
        FROM vec GROUP BY term, id, covered""",
    "wordvec_coverage": f"""{_ALIGNED}, c AS (SELECT term, any_value(covered) AS covered FROM vec GROUP BY term)
        SELECT count(*) FILTER (WHERE covered) AS found, count(*) AS vocab_size,
               {sql.rounded('count(*) FILTER (WHERE covered) / count(*)')} AS coverage FROM c""",
    "node_features": f"""{_ALIGNED}, enc AS (SELECT doc_id, pos, coalesce(id, 1) AS id FROM rawt LEFT JOIN vocab USING (term)),
        hid AS (SELECT id, {_LAYER} FROM vec GROUP BY id)
        SELECT doc_id, {_sums('h')} FROM (SELECT DISTINCT doc_id, id FROM enc) JOIN hid USING (id) GROUP BY doc_id""",
    "edge_attention": _attention_sql(),
    "diffusion_step": _heads_sql(1),
    "diffusion_k": _heads_sql(STEPS),
    "gat_layer": f"""{_START}, {layer_sql('l', 'n0', WEIGHTS.layers[0], STEPS, False)}
        SELECT doc_id, {_sums('h')} FROM l GROUP BY doc_id""",
    "graph_readout": f"{_START}, {_readout_sql('n0', 0.1)} SELECT doc_id, {_ROUNDED_READOUT} FROM rd",
    "gat_stack": f"{_stack_sql()} SELECT doc_id, {_ROUNDED_READOUT} FROM rd",
    "graph_logits": f"""{_stack_sql()}, lg AS (SELECT doc_id, {', '.join(f'{e} AS z{i}' for i, e in enumerate(_LOGITS))} FROM rd)
        SELECT doc_id, {', '.join(f"{sql.rounded(f'z{i}')} AS z{i}" for i in range(3))},
               CAST(list_position([z0, z1, z2], greatest(z0, z1, z2)) - 1 AS INTEGER) AS pred FROM lg""",
}
