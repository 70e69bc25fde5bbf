"""The Jaccard join, nearest neighbours and the pipeline against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textspark.llm import ann, jaccard, mixing, queries
from textspark.registry.compare import connect, difference

from textspark.session import materialise

from .fixtures import documents, linked, measures, no_documents, sentence, shingles, words


def components(rows):
    """Class of each row by all pairs."""
    sets = [shingles(r.text) for r in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        ids = [x for x in (least.get(root(i)), r.doc_id) if x is not None]
        least[root(i)] = min(ids) if ids else None
    return [(r.doc_id, r.text, len(s), least[root(i)]) for i, (r, s) in enumerate(zip(rows, sets))]


def near_copies(seed, families=12):
    """Families with every number of changed words from none to many, so similarities pass through the bound."""
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    passage = sentence(rng, 60, vocabulary)
    texts = []
    for f in range(families):
        base = sentence(rng, rng.randint(8, 160), vocabulary).split()
        for changes in range(rng.randint(2, 14)):
            copy = list(base)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy[: len(copy) - rng.randint(0, changes)]))
        texts.append(passage + " " + sentence(rng, rng.randint(10, 150), vocabulary))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_are_those_of_all_pairs(spark, seed):
    docs = documents(spark, near_copies(seed))
    rows = jaccard.classes(docs).select("_row.doc_id", "_row.text", "n", "component_id", "keeper").collect()
    assert Counter((r.doc_id, r.text, r.n, r.component_id) for r in rows) == Counter(components(docs.collect()))
    kept = Counter(r.component_id for r in rows if r.keeper and r.n)
    assert kept and max(kept.values()) == 1
    assert all(r.doc_id == r.component_id for r in rows if r.keeper)


def test_small_nodes_and_slices_change_nothing(spark, monkeypatch):
    docs = documents(spark, near_copies(3))
    want = Counter(components(docs.collect()))
    monkeypatch.setattr(jaccard, "NODE_DOCS", 3)
    monkeypatch.setattr(jaccard, "SLICE_TOKENS", 50)
    monkeypatch.setattr(jaccard, "SAMPLE_SHARE", 1)
    rows = jaccard.classes(docs.repartition(6)).select("_row.doc_id", "_row.text", "n", "component_id").collect()
    assert Counter(map(tuple, rows)) == want


def test_walk_finds_all_classes():
    """Dual traversal against all pairs, for sets just above and below the bound."""
    rng = np.random.default_rng(5)
    for _ in range(20):
        base = rng.integers(0, 2**64, 80, dtype=np.uint64)
        sets = []
        for _ in range(rng.integers(2, 60)):
            keep = rng.random(len(base)) > rng.random() * 0.3
            sets.append(np.unique(np.concatenate([base[keep], rng.integers(0, 2**64, rng.integers(0, 20), dtype=np.uint64)])))
        up = {}

        def root(x):
            while up.get(x, x) != x:
                x = up[x]
            return x

        tree = jaccard._Tree(list(range(len(sets))), sets, 9)
        for p, q in jaccard.walk(tree, tree, root):
            up[root(p)] = root(q)
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    assert root(i) == root(j)


def test_prefix_overlap_is_no_more_than_any_pair_must_share():
    for low in range(1, 200):
        least = low
        for high in range(low, low * 4 // 3 + 1):
            for a in (low, high):
                least = min(least, max(jaccard.needed(a, high) - -(-high * 3 // 4) + 1, 1))
            assert jaccard.overlap_of_prefixes(low, high) <= least, (low, high)


def test_a_pair_at_the_bound_meets_in_a_node_of_larger_sets():
    """Sets of 90 and 99 tokens share 81, so are linked; the second one's node has a set of 100, linked with neither."""
    few, rest = list(range(10, 17)), list(range(200, 274))
    a, b, c = ([*range(1, 10), *few, *rest], [*few, *range(20, 38), *rest], [*few, *range(40, 59), *rest])
    sets = [np.array(s, np.uint64) for s in (a, c, b)]
    assert [len(s) for s in sets] == [90, 100, 99]
    columns = [
        pa.array([0, 1, 2]), pa.array([len(s) for s in sets]), pa.array([int(s[0]) for s in sets]), pa.array([s.tobytes() for s in sets], pa.binary()),
        pa.array([(jaccard.prefix(s, np.zeros(0, np.uint64)) * jaccard._MIX).tobytes() for s in sets], pa.binary()),
    ]
    parts = jaccard._nodes(0)(iter([pa.RecordBatch.from_arrays(columns, names=["_rid", "n", "leaf", "digest", "prefix"])]))
    found = [r for batch in jaccard._meetings(parts) for r in batch.to_pylist()]
    assert {r["a"]: r["b"] for r in found if r["kind"] == "member"} == {0: 0, 1: 1, 2: 1}
    assert [(r["a"], r["b"]) for r in found if r["kind"] == "pair" and r["place"] >= r["need"]] == [(0, 1)]


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(9)
    base = sentence(rng, 120, ["w%d" % i for i in range(300)]).split()
    texts = []
    for i in range(700):
        copy = list(base)
        copy[rng.randrange(120)] = "x%d" % i
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts + [texts[0]] * 50)), "doc_id long, text string")
    assert {r.component_id for r in jaccard.classes(docs).collect()} == {0}
    assert [r.doc_id for r in jaccard.deduplicated(docs).collect()] == [0]


def test_links_of_nothing(spark):
    assert jaccard.classes(no_documents(spark)).count() == 0
    assert jaccard.deduplicated(no_documents(spark)).columns == no_documents(spark).columns
    blank = documents(spark).where("text is null or text = ''")
    assert jaccard.deduplicated(blank).count() == blank.count()


def test_connected_on_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (300, 299), (298, 299), (297, 298)]
    got = {r.node: r.label for r in jaccard.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {i: 297 for i in range(297, 301)}
    assert got == want


def brute(vectors, ids, asks, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(asks):
        s = unit @ unit[i]
        order = [j for j in np.lexsort((ids, -np.round(s, 12))) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((1500, 24)).astype(np.float32)
    vectors[200:700] = vectors[0]  # one vector is shared by a third of all rows
    ids = np.arange(len(vectors))
    rows = [(int(i), v.tolist(), "x") for i, v in zip(ids, vectors)]
    odd = [(2000, None, "x"), (2050, [0.0] * 24, "x"), (2100, [float("nan")] * 24, "x"), (2150, [1.0, None] * 12, "x"), (2200, [1.0], "x"), (2250, [float("inf")] * 24, "x"), (2300, [], "x")]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, node string")
    found = ann.nearest(table, F.col("id") % 50 == 0).collect()
    want = brute(vectors.astype(np.float64), ids, ids % 50 == 0, 5)
    by = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(by) == set(want)
    hits = 0
    for q, got in by.items():
        assert len(got) == 5 and [s for _, s in got] == sorted((s for _, s in got), reverse=True)
        unit = vectors.astype(np.float64)
        for v, s in got:
            assert s == pytest.approx(unit[q] @ unit[v] / np.linalg.norm(unit[q]) / np.linalg.norm(unit[v]), abs=1e-12)
        hits += len({v for v, _ in got} & {v for v, _ in want[q]})
    assert hits >= 0.9 * 5 * len(want)
    shared = [q for q in want if 200 <= q < 700]
    assert [[v for v, _ in by[q]] for q in shared] == [[0, 200, 201, 202, 203] if q != 200 else [0, 201, 202, 203, 204] for q in shared]


def test_neighbours_of_few(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (50, [0.0, 2.0])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(few, F.col("id") % 50 == 0).collect()}
    assert got == {(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)}
    assert ann.nearest(few.limit(0), F.col("id") % 50 == 0).count() == 0
    assert ann.nearest(few.limit(1), F.col("id") % 50 == 0).count() == 0


def test_neighbours_of_extreme_and_repeated_rows(spark):
    """Squares beyond the range of doubles, keys that repeat, and columns named like the operator's own."""
    rows = [(0, [1e-200, 0.0]), (1, [3e-200, 1e-200]), (2, [1e200, 1e200]), (2, [0.0, 5.0]), (50, [1e200, -1e199]), (50, [1e200, -1e199])]
    names = ["q", "v", "score", "rank", "id", "original", "turn", "done", "query_id", "node"]
    table = spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], "vec_id long, embedding array<double>, " + ", ".join(f"{n} string" for n in names))
    got = ann.nearest(table, F.col("id") % 50 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    found = sorted(tuple(r) for r in got.collect())
    # The two rows with key 50 are equal, so they are one; the two with key 2 are not.
    want = [(0, 1, 50, 10 / np.sqrt(101)), (0, 2, 1, 3 / np.sqrt(10)), (0, 3, 2, np.sqrt(0.5)), (0, 4, 2, 0.0)]
    want += [(50, 1, 0, 10 / np.sqrt(101)), (50, 2, 1, 29 / np.sqrt(1010)), (50, 3, 2, 9 / np.sqrt(202)), (50, 4, 2, -1 / np.sqrt(101))]
    assert [r[:3] for r in found] == [r[:3] for r in want]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in want])


def test_the_search_keeps_a_beam_and_ends(spark, monkeypatch):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((400, 8)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    nodes, _ = ann.nodes_of(rows, "vec_id", "embedding")
    graph = ann.neighbour_graph(nodes, 8)
    asked = spark.range(0, 400, 50).withColumnRenamed("id", "q")
    found = ann.search(nodes, graph, asked, beam=40)
    assert {r["count"] for r in found.groupBy("q").count().collect()} == {40}
    assert found.groupBy("q", "v").count().where("count > 1").isEmpty() and found.where("q = v").isEmpty()


def test_a_round_is_few_jobs(spark, monkeypatch):
    """The driver keeps something of every job, shuffle and broadcast; the session's settings come back."""
    rng = np.random.default_rng(11)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((600, 8)))], "vec_id long, embedding array<double>")
    nodes, _ = ann.nodes_of(rows, "vec_id", "embedding")
    graph = materialise(ann.neighbour_graph(nodes, 8))
    asked = nodes.limit(20).select(F.col("node").alias("q"))
    written = []
    monkeypatch.setattr(ann, "materialise", lambda df: written.append(df) or materialise(df))
    monkeypatch.setattr(ann, "EXPAND", 8)
    keys = ["spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(k, None) for k in keys]
    spark.sparkContext.setJobGroup("search", "search")
    try:
        found = ann.search(nodes, graph, asked, beam=24)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("search")
    assert found.groupBy("q").count().where("count = 24").count() == 20
    assert len(written) > 3 and len(jobs) <= 4 * len(written), (len(written), len(jobs))
    assert [spark.conf.get(k, None) for k in keys] == before


def test_pipeline_stages(spark, sf_dir):
    """Each stage against its contract on what the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, counts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = materialise(stage(spark, docs, sf_dir))
        after = docs.collect()
        counts.append(len(after))
        if name == "quality rules":
            assert {r.doc_id for r in after} <= {r.doc_id for r in before}
            for r in after:
                n, _, _, _, repeated = measures(r.text)
                assert n >= 50 and 100 * repeated <= 50 * n
        if name == "n-gram Jaccard join":
            assert {r.doc_id for r in after} == {c[3] for c in components(before)}
        if name == "mixing sources to target weights":
            taken = Counter()
            for r in mixing.mix_plan(spark.createDataFrame(before, docs.schema)).collect():
                taken[r.doc_id] += r.taken
            got = Counter()
            for r in after:
                got[r.doc_id] += len(words(r.text))
            assert got == +taken
        if name != "packing":
            assert docs.columns == names
        else:
            assert {r.doc_id for r in after} == {r.doc_id for r in before}
    assert all(counts)


def test_the_pipeline_bears_odd_tables(spark, tmp_path):
    """Nulls in every column, clashing names, repeated rows, empty and long texts; and no documents at all."""
    odd, none = str(tmp_path / "odd"), str(tmp_path / "none")
    documents(spark).write.parquet(f"{odd}/documents.parquet")
    no_documents(spark).write.parquet(f"{none}/documents.parquet")
    pieces = corpus_pipeline.run(spark, odd).collect()
    given = documents(spark).collect()
    assert pieces and {p.doc_id for p in pieces} <= {r.doc_id for r in given if measures(r.text)[0] >= 50}
    assert corpus_pipeline.run(spark, none).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, sf_dir, name):
    with connect(sf_dir) as duck:
        assert difference(spark, duck, sf_dir, queries.QUERIES[name], queries.ORACLES[name]) == ""


def test_queries_return_every_row(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("op4_sharding", "op5_quality", "op6_tokens", "op10_mixing"):
        assert queries.QUERIES[name](spark, sf_dir).count() == docs
    assert queries.op2_urls(spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
