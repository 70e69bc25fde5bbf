import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textspark.operators import graph
from textspark.operators.graph import Head
from textspark.plans import graph_model
from textspark.plans.graph_model import GraphWeights, graph_logits, graph_readouts, project_terms
from textspark.session import materialise


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, [5, 6, 5, 7]), (2, []), (3, [9]), (4, [9, 7, 9, 9, 5, 6, 5, 5, 7, 6])]
    return materialise(spark.createDataFrame(rows, "doc_id long, ids array<long>"))


@pytest.fixture(scope="module")
def hidden(spark):
    rows = [(5, [1.0, -0.5]), (6, [2.0, 0.3]), (7, [4.0, 1.0]), (9, [1.0, 0.2]), (11, [0.0, 0.0])]
    return spark.createDataFrame(rows, "id long, h array<double>")


def test_nodes_and_edges(docs):
    g = graph.document_graphs(docs, ngram=3)
    nodes = [tuple(r) for r in graph.graph_nodes(g).where("doc_id = 1").orderBy("idx").collect()]
    assert nodes == [(1, 0, 5), (1, 1, 6), (1, 2, 7)]
    edges = {(r["src"], r["dst"]): r["mult"] for r in graph.graph_edges(g).where("doc_id = 1").collect()}
    assert edges == {(5, 6): 1, (6, 5): 1, (6, 7): 1, (5, 7): 1, (5, 5): 1, (6, 6): 1, (7, 7): 1}
    assert graph.graph_edges(g).where("doc_id = 2").count() == 0
    lone = graph.graph_edges(graph.document_graphs(docs, ngram=1))
    assert lone.where("src <> dst").count() == 0 and lone.count() == 8


def brute_edges(ids, ngram):
    out = {}
    for i in range(len(ids)):
        for j in range(i + 1, min(i + ngram, len(ids))):
            if ids[i] != ids[j]:
                out[ids[i], ids[j]] = out.get((ids[i], ids[j]), 0) + 1
    for v in ids:
        out[v, v] = 1
    return out


@pytest.mark.parametrize("offset", [0, 1 << 40])
@pytest.mark.parametrize("ngram", [2, 4])
def test_edges_by_brute_force(spark, offset, ngram):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(0, 6, rng.integers(0, 30)) + offset).tolist()) for i in range(20)]
    g = graph.document_graphs(spark.createDataFrame(rows, "doc_id long, ids array<long>"), ngram)
    got = {}
    for r in graph.graph_edges(g).collect():
        got.setdefault(r["doc_id"], {})[r["src"], r["dst"]] = r["mult"]
    assert got == {i: brute_edges(ids, ngram) for i, ids in rows if ids}


def test_truncation(docs):
    g = graph.document_graphs(docs, 3, max_length=2)
    assert graph.graph_nodes(g).where("doc_id = 4").count() == 2


def projected(spark):
    rows = [(1, 5, 1.0, 0.0), (1, 6, 2.0, math.log(2)), (1, 7, 4.0, math.log(3))]
    return spark.createDataFrame(rows, "doc_id long, node long, f0 double, el0 double")


def test_golden_diffusion(spark, docs):
    edges = graph.graph_edges(graph.document_graphs(docs, 3)).where("doc_id = 1")
    attention = graph.edge_attention(edges, projected(spark))
    got = {(r["src"], r["dst"]): round(r["a0"], 6) for r in attention.collect()}
    assert got == {
        (5, 6): 0.333333, (6, 5): 0.666667, (6, 7): 0.333333, (5, 7): 0.166667,
        (5, 5): 0.333333, (6, 6): 0.666667, (7, 7): 0.5,
    }
    for k, want in ((1, [1.333333, 1.833333, 3.416667]), (2, [1.333333, 1.833333, 3.270833])):
        z = graph.diffuse(attention, projected(spark), 1, 1, k, 0.5).orderBy("node").collect()
        assert [round(r["z0"], 6) for r in z] == want


def test_steps_deal_no_row_again(spark, docs):
    edges = graph.graph_edges(graph.document_graphs(docs, 3)).where("doc_id = 1")
    attention = graph.edge_attention(edges, projected(spark))
    with graph.by_document(spark):
        for plan, sides in ((graph.diffusion_plan(attention, projected(spark), 1, 1, 3, 0.5), 4), (graph.attention_plan(edges, projected(spark), 1), 2)):
            text = plan._jdf.queryExecution().executedPlan().toString()
            # One exchange for the nodes, and one for the edges wherever they are read; both by the request to deal them.
            exchanges = [line for line in text.splitlines() if "Exchange" in line]
            assert len(exchanges) == sides and all("REPARTITION_BY_COL" in line for line in exchanges)
    assert spark.conf.get(graph.CO_PARTITION) == "true"


def test_attention_into_a_node_sums_to_one_at_any_scale(docs, hidden):
    nodes = graph.node_features(graph.graph_nodes(graph.document_graphs(docs)), hidden)
    steep = Head([[300.0, 0.0], [0.0, 300.0]], [3.0, -2.0])
    attention = graph.edge_attention(graph.graph_edges(graph.document_graphs(docs)), graph.project(nodes, [steep, steep]), 2)
    sums = attention.groupBy("doc_id", "dst").agg(F.sum("a0").alias("s"), F.sum("a1").alias("t"))
    assert sums.where("abs(s - 1) > 1e-9 or s is null or s <> t").count() == 0


def plain_readout(ids, table, weights, k, alpha, ngram, target_score=0.0):
    """The model over a list of edges; ``target_score`` adds a score of the target to each edge."""
    width = len(weights.gate)
    if not ids:
        return np.zeros(width)
    order = list(dict.fromkeys(ids))
    at = {v: i for i, v in enumerate(order)}
    edges = [
        (at[ids[i]], at[ids[j]])
        for i in range(len(ids))
        for j in range(i + 1, min(i + ngram, len(ids)))
        if ids[i] != ids[j]
    ] + [(i, i) for i in range(len(order))]
    h = np.array([table[v] for v in order])
    for layer, heads in enumerate(weights.layers):
        outs = []
        for head in heads:
            feat = h @ np.array(head.w)
            el = feat @ np.array(head.a)
            e = np.array([np.exp(el[s] + target_score * el[d]) for s, d in edges])
            total = np.zeros(len(order))
            for (_, d), x in zip(edges, e):
                total[d] += x
            z = feat
            for _ in range(k):
                moved = np.zeros_like(feat)
                for (s, d), x in zip(edges, e):
                    moved[d] += x / total[d] * z[s]
                z = alpha * feat + (1 - alpha) * moved
            outs.append(z)
        h = np.mean(outs, axis=0)
        if layer < len(weights.layers) - 1:
            h = np.where(h > 0, h, np.exp(h) - 1)
    gate = 1 / (1 + np.exp(-(h @ np.array(weights.gate) + weights.gate_bias)))
    return (h * gate[:, None]).sum(0)


def test_three_ways_to_score_agree(docs, hidden):
    weights = GraphWeights.start(2, 2, num_layers=3, num_heads=2)
    table = {r["id"]: r["h"] for r in hidden.collect()}
    ids = {r["doc_id"]: r["ids"] for r in docs.collect()}
    want = {i: plain_readout(v, table, weights, 3, 0.4, 3, 0.7) for i, v in ids.items()}
    shipped = graph_readouts(docs, hidden, weights, 3, 0.4, 3)
    joined = graph_readouts(docs, hidden, weights, 3, 0.4, 3, limit=0)
    g = materialise(graph.document_graphs(docs, 3))
    nodes, edges = graph.node_features(graph.graph_nodes(g), hidden), graph.graph_edges(g)
    for i, layer in enumerate(weights.layers):
        last = i == len(weights.layers) - 1
        nodes = materialise(graph.gat_layer(nodes, edges, layer, 3, 0.4, last))
    relational = graph.graph_readout(docs, nodes, weights.gate, weights.gate_bias)
    for way in (shipped, joined, relational):
        got = {r["doc_id"]: r["readout"] for r in way.collect()}
        assert got.keys() == want.keys()
        for i in want:
            assert np.allclose(got[i], want[i], atol=1e-9)


def test_scoring_moves_no_rows(docs, hidden):
    weights = GraphWeights.start(2, 2, 2, 1)
    plan = graph_readouts(docs, hidden, weights)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "Exchange" not in plan


def test_joined_features_never_pass_through_the_driver(docs, hidden, monkeypatch):
    def refused(self):
        raise AssertionError("collected")

    weights = GraphWeights.start(2, 2, 2, 1)
    assert graph_model.SHIPPED_BYTES <= 16 << 20
    monkeypatch.setattr(type(hidden), "toPandas", refused)
    plan = graph_readouts(docs, hidden, weights, limit=0)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "posexplode" not in plan


def test_graphs_in_chunks_agree_with_the_relational_steps(docs, hidden):
    heads = [Head([[1.0, -0.3], [0.2, 0.7]], [0.4, -0.6]), Head([[0.5, 0.1], [-0.2, 0.9]], [1.1, 0.3])]
    g = graph.document_graphs(docs, 3)
    nodes, edges = graph.node_features(graph.graph_nodes(g), hidden), graph.graph_edges(g)
    projected = graph.project(nodes, heads)
    attention = graph.edge_attention(edges, projected, 2)
    pairs = [
        (graph_model.graph_attention(docs, hidden, heads, 3), attention),
        (graph_model.graph_diffusion(docs, hidden, heads, 2, 0.4, 3), graph.diffuse(attention, projected, 2, 2, 2, 0.4)),
    ]
    for got, want in pairs:
        assert got.columns == want.columns
        a, b = (sorted(tuple(r) for r in x.collect()) for x in (got, want))
        assert len(a) == len(b) and np.allclose(a, b)
    layers = [graph_model.graph_layer(docs, hidden, heads, 2, 0.4, False, 3), graph.gat_layer(nodes, edges, heads, 2, 0.4, False)]
    a, b = ({(r["doc_id"], r["node"]): r["h"] for r in x.collect()} for x in layers)
    assert a.keys() == b.keys() and all(np.allclose(a[i], b[i]) for i in a)
    plan = pairs[0][0]._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "FlatMapGroupsInArrow" in plan


def test_documents_in_one_batch_do_not_mix(spark, docs, hidden):
    weights = GraphWeights.start(2, 2, 3, 2)
    apart = graph_readouts(docs.repartition(4, "doc_id"), hidden, weights).collect()
    together = graph_readouts(docs.coalesce(1), hidden, weights).collect()
    assert len(apart) == len(together) == 4
    for a, b in zip(sorted(apart), sorted(together)):
        assert a["doc_id"] == b["doc_id"] and np.allclose(a["readout"], b["readout"])


def test_layer_counts():
    assert [len(GraphWeights.start(2, 2, n, 3).layers) for n in (0, 1, 2, 3)] == [2, 2, 2, 3]
    layers = GraphWeights.start(2, 2, 3, 3).layers
    assert [len(heads) for heads in layers] == [3, 3, 1]
    w = GraphWeights.start(2, 2, 3, 1)
    assert GraphWeights.from_dict(w.to_dict()) == w


def test_wide_and_narrow_projection_agree(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=40).tolist()) for i in range(5)]
    vectors = spark.createDataFrame(rows, "id long, vec array<double>")
    wide = GraphWeights.start(40, 30, 2, 1)
    got = {r["id"]: r["h"] for r in project_terms(vectors, wide).collect()}
    same = {r["id"]: r["h"] for r in graph.term_hidden(vectors, wide.w_in, wide.b_in).collect()}
    assert got.keys() == same.keys()
    for i in got:
        assert np.allclose(got[i], same[i])


def test_linear_head(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "doc_id long, readout array<double>")
    row = graph_logits(df, [[1.0, 0.0], [0.5, 2.0]], [0.5, -1.0]).first()
    assert row["logits"] == [2.5, 3.0] and row["pred"] == 1


def test_wide_graphs_are_matrices_where_that_is_less_work():
    """Readouts of small and of large graphs, wide enough for matrices, against the steps edge by edge."""
    rng = np.random.default_rng(3)
    layers = [[(rng.normal(size=(40, 40)) / 6, rng.normal(size=40)) for _ in range(2)] for _ in range(2)]
    docs = [rng.integers(0, 9, 60), np.array([], int), rng.permutation(500), np.array([4])]
    table, gate = rng.normal(size=(500, 40)), rng.normal(size=40)
    got = graph_model._readout(docs, lambda ids: table[ids], layers, gate, 0.1, 4, 3, 0.5)
    by_graph, calls = graph_model._by_graph, []
    graph_model._by_graph = lambda *a: calls.append(1) or by_graph(*a)
    width, graph_model.DENSE_WIDTH = graph_model.DENSE_WIDTH, 1 << 30
    try:
        plain = graph_model._readout(docs, lambda ids: table[ids], layers, gate, 0.1, 4, 3, 0.5)
        assert not calls
        graph_model.DENSE_WIDTH = width
        graph_model._readout(docs, lambda ids: table[ids], layers, gate, 0.1, 4, 3, 0.5)
        assert len(calls) == 4
    finally:
        graph_model._by_graph, graph_model.DENSE_WIDTH = by_graph, width
    assert np.allclose(got, plain, rtol=1e-12, atol=1e-12) and not got[1].any()


def test_graphs_of_any_documents_match_plain_counting(spark, monkeypatch):
    """Wide ids, missing documents and missing ids, whatever documents are sorted together; one task makes no shuffle."""
    rng = np.random.default_rng(1)
    given = [[int(x) for x in rng.integers(0, 6, rng.integers(0, 30))] for _ in range(12)]
    given += [[2**40, 3, 2**40, None, 3, None], [], None, [-5, 7, -5]]
    docs = spark.createDataFrame(list(enumerate(given)), "doc_id long, ids array<long>")
    for chunk in (1, 40, 1 << 18):
        monkeypatch.setattr(graph, "CHUNK_TOKENS", chunk)
        for ngram in (1, 4):
            built = graph.document_graphs(docs, ngram)
            assert "Exchange" not in built._jdf.queryExecution().executedPlan().toString()
            for r in built.collect():
                ids = given[r["doc_id"]]
                if ids is None:
                    assert r["nodes"] is None and r["edges"] is None
                    continue
                nodes = list(dict.fromkeys(ids))
                pairs = [(a, b) for d in range(1, ngram) for a, b in zip(ids, ids[d:]) if a != b and None not in (a, b)]
                want = [(a, b, pairs.count((a, b))) for a, b in sorted(set(pairs))] + [(v, v, 1) for v in nodes]
                assert r["nodes"] == nodes and [tuple(e) for e in r["edges"]] == want


def test_edges_leave_the_jvm_of_sorts_per_row(spark):
    docs = spark.createDataFrame([(1, [1, 2, 1])], "doc_id long, ids array<long>")
    plan = graph.graph_edges(graph.document_graphs(docs))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "sort_array" not in plan
