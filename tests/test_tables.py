"""Vocabulary, ranks, lookups, labels and segmentation."""

import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textspark import session
from textspark.operators import labels, segment, softmax, vocab
from textspark.operators.lookup import fits, lookup, measured_bytes
from textspark.operators.rank import global_rank


def test_global_rank_is_exact(spark):
    random.seed(3)
    words = sorted({"".join(random.choices("abcÉ中z", k=random.randint(1, 6))) for _ in range(3000)})
    df = spark.createDataFrame([(w,) for w in random.sample(words, len(words))], "term string").repartition(7)
    got = {r["term"]: r["id"] for r in global_rank(df, ["term"], "id", start=2).collect()}
    assert got == {w: i for i, w in enumerate(words, start=2)}


def test_global_rank_of_nothing(spark):
    assert global_rank(spark.createDataFrame([], "term string"), ["term"], "id").count() == 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_ways_agree_under_skew(spark, how):
    facts = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key"),
        F.col("id").alias("n"),
    )
    dim = facts.groupBy("key").agg(F.count("*").alias("freq")).where("key <> 'k7'").withColumn("v", F.hash("key"))
    assert fits(dim) and not fits(dim, 10) and measured_bytes(dim) > 500 * 16
    ways = [
        lookup(facts, dim, "key", how, "freq"),
        lookup(facts, dim, "key", how, "freq", limit=0),
        lookup(facts, dim, "key", how, limit=0),
    ]
    rows = [sorted(map(tuple, w.select("key", "n", "v").collect()), key=repr) for w in ways]
    assert rows[0] == rows[1] == rows[2]
    salted = ways[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in salted


def test_vocabulary_and_encoding(spark):
    docs = spark.createDataFrame(
        [(1, ["b", "a", "b"]), (2, ["c", "zz"]), (3, []), (4, ["<UNK>", "a"])], "doc_id long, tokens array<string>"
    )
    table = vocab.build_vocab(docs.where("doc_id < 3"), min_freq=1)
    assert [tuple(r) for r in table.orderBy("id").collect()] == [
        ("<PAD>", 0, 0), ("<UNK>", 1, 0), ("a", 2, 1), ("b", 3, 2), ("c", 4, 1), ("zz", 5, 1),
    ]
    assert vocab.build_vocab(docs.where("doc_id < 3"), min_freq=2).count() == 3
    small = vocab.build_vocab(docs.where("doc_id = 1"))
    for limit in (1 << 20, 0):
        got = {r["doc_id"]: r["ids"] for r in vocab.encode(docs, small, limit=limit).collect()}
        assert got == {1: [3, 2, 3], 2: [1, 1], 3: [], 4: [1, 2]}
    cut = {r["doc_id"]: r["ids"] for r in vocab.encode(docs, small, max_length=2).collect()}
    assert cut[1] == [3, 2]


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "label_raw string, c_numerical int")


def test_label_orders_differ(spark):
    train, dev = pairs(spark, ("乙", 0), ("甲", 2), ("丙", 1)), pairs(spark, ("乙", 0), ("甲", 2))
    by_text = [r["label_raw"] for r in labels.label_index(train).orderBy("idx").collect()]
    by_code = [r["label_raw"] for r in labels.label_index_by_code(train).orderBy("idx").collect()]
    assert by_text == ["丙", "乙", "甲"] and by_code == ["乙", "丙", "甲"]
    assert labels.labels_missing(train, dev).count() == 0
    assert labels.label_metadata(train, dev).count() == 3


def test_missing_labels_are_named(spark):
    train, dev = pairs(spark, ("乙", 0)), pairs(spark, ("丁", 3), ("乙", 0))
    with pytest.raises(ValueError, match="丁"):
        labels.label_metadata(train, dev)
    with pytest.raises(ValueError, match="丁"):
        labels.encode_labels(dev, labels.label_index(train))


def test_label_codes_last_wins(spark):
    train, dev = pairs(spark, ("a", 1), ("b", 2)), pairs(spark, ("a", 3), ("c", 0))
    got = {r["label_raw"]: r["c_numerical"] for r in labels.label_codes(train, dev).collect()}
    assert got == {"a": 3, "b": 2, "c": 0}


def test_label_round_trip(spark):
    df = pairs(spark, ("x", 0), ("y", 1), ("x", 0))
    index = labels.label_index(df)
    back = labels.decode_labels(labels.encode_labels(df, index).select("idx"), index)
    assert sorted(r["label_raw"] for r in back.collect()) == ["x", "x", "y"]


def longest_match(run, words, longest):
    out, i = [], 0
    while i < len(run):
        n = next((n for n in range(min(longest, len(run) - i), 1, -1) if run[i : i + n] in words), 1)
        out.append(run[i : i + n])
        i += n
    return out


def test_segmentation_matches_the_definition(spark):
    random.seed(5)
    words = {"".join(random.choices("一二三四", k=random.randint(1, 5))) for _ in range(40)}
    runs = sorted({"".join(random.choices("一二三四五", k=random.randint(1, 30))) for _ in range(200)})
    table = spark.createDataFrame([(w,) for w in words], "term string")
    df = spark.createDataFrame([(r,) for r in runs], "run string")
    want = {r: longest_match(r, words, 5) for r in runs}
    for limit in (1 << 20, 0):
        got = segment.segment_runs(df, table, limit).collect()
        assert {r["run"]: r["pieces"] for r in got} == want


def best_path(run, freq):
    """The most probable segmentation by trying all; of equal ones the longer word first."""
    total = sum(freq.values())

    def cost(word):
        return round(math.log(freq.get(word, 1) / total) * 1_000_000)

    best = {len(run): (0, [])}
    for i in range(len(run) - 1, -1, -1):
        ends = [j for j in range(i + 1, len(run) + 1) if j == i + 1 or run[i:j] in freq]
        best[i] = max(((cost(run[i:j]) + best[j][0], [run[i:j], *best[j][1]]) for j in ends), key=lambda x: (x[0], len(x[1][0])))
    return best[0][1]


def test_best_paths_are_those_of_all_paths(spark):
    random.seed(6)
    words = {"".join(random.choices("一二三四", k=random.randint(1, 5))) for _ in range(40)}
    runs = sorted({"".join(random.choices("一二三四五", k=random.randint(1, 30))) for _ in range(150)})
    times = {r: random.randint(1, 50) for r in runs}
    freq = Counter()
    for run, n in times.items():
        for i in range(len(run)):
            for j in range(i + 1, len(run) + 1):
                if j == i + 1 or run[i:j] in words:
                    freq[run[i:j]] += n
    table = spark.createDataFrame([(w,) for w in words], "term string")
    counted = spark.createDataFrame(list(times.items()), "run string, times long")
    for limit in (1 << 20, 0):
        found = segment.run_frequencies(counted, table, limit)
        assert {r["term"]: r["freq"] for r in found.collect()} == freq
        got = segment.segment_runs(counted.select("run"), found, limit).collect()
        assert {r["run"]: r["pieces"] for r in got} == {r: best_path(r, freq) for r in runs}
    other = spark.createDataFrame([("六七一二",)], "run string")  # characters the table does not know
    assert segment.segment_runs(other, found).first()["pieces"] == best_path("六七一二", freq)
    assert any(best_path(r, freq) != longest_match(r, words, 5) for r in runs)


def test_tokenize_by_the_best_path(spark):
    df = spark.createDataFrame([(1, "研究生命起源 study"), (2, "研究生命"), (3, "研究"), (4, "生命"), (5, "生命研究"), (6, None), (7, "研究生")], "doc_id long, sentence_sep string")
    words = spark.createDataFrame([("研究",), ("研究生",), ("生命",), ("起源",)], "term string")
    freq = segment.word_frequencies(df, words)
    assert {r["term"]: r["freq"] for r in freq.collect()}["研究"] == 5
    got = {r["doc_id"]: r["tokens"] for r in segment.tokenize_dict(df, freq).collect()}
    assert got[1] == ["研究", "生命", "起源", "study"] and got[6] == []
    longest = {r["doc_id"]: r["tokens"] for r in segment.tokenize_dict(df, words).collect()}
    assert longest[1] == ["研究生", "命", "起源", "study"]


def test_tokenize_by_dictionary(spark):
    df = spark.createDataFrame([(1, "Hi中文吗[SEP]文中文 ok!"), (2, ""), (3, "中文中文")], "doc_id long, sentence_sep string")
    words = spark.createDataFrame([("中文",)], "term string")
    got = {r["doc_id"]: r["tokens"] for r in segment.tokenize_dict(df, words).collect()}
    assert got == {1: ["Hi", "中文", "吗", "文", "中文", "ok"], 2: [], 3: ["中文", "中文"]}


def test_tokenize_by_dictionary_raw_and_without_stop_words(spark):
    df = spark.createDataFrame([(1, "中文 的,x1"), (2, None), (3, "")], "doc_id long, sentence_sep string")
    words = spark.createDataFrame([("中文",)], "term string")
    raw = {r["doc_id"]: r["tokens"] for r in segment.tokenize_dict(df, words, raw=True, null_token="nan").collect()}
    assert raw == {1: ["中文", " ", "的", ",", "x1"], 2: ["nan"], 3: []}
    kept = {r["doc_id"]: r["tokens"] for r in segment.tokenize_dict(df, words, remove_stopwords=True).collect()}
    assert kept == {1: ["中文", "x1"], 2: [], 3: []}


def test_unknown_labels_are_all_listed(spark):
    known = spark.createDataFrame([("a", 0)], "label_raw string, c_numerical int")
    other = spark.createDataFrame([(f"x{i:03d}", 0) for i in range(150)], "label_raw string, c_numerical int")
    with pytest.raises(ValueError, match="x000, x001") as error:
        labels.label_metadata(known, other)
    message = str(error.value)
    assert "150 in all" in message and spark.read.parquet(message.rsplit(" ", 1)[1].rstrip(")")).count() == 150


def test_hot_keys_get_salts_by_weight(spark):
    facts = spark.createDataFrame([("a", i) for i in range(900)] + [(f"k{i}", i) for i in range(100)] + [(None, 7)], "key string, v long")
    dim = facts.where("key is not null").groupBy("key").agg(F.count("*").alias("n")).withColumn("d", F.upper("key"))
    small = lookup(facts, dim, "key", "left", "n")
    large = lookup(facts, dim, "key", "left", "n", limit=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.select(small.columns).collect()))


def test_measured_bytes_counts_nested_strings(spark):
    text = spark.createDataFrame([(["x" * 1000] * 5,)], "a array<string>")
    assert measured_bytes(text) > 5000
    assert measured_bytes(text.select(F.transform("a", lambda x: F.struct(x.alias("s"))).alias("b"))) > 5000


def test_minibatches(spark):
    df = spark.range(10).withColumnRenamed("id", "doc_id")
    one = {r["doc_id"]: r["batch"] for r in softmax.minibatches(df, 4, 42, 1).collect()}
    again = {r["doc_id"]: r["batch"] for r in softmax.minibatches(df.repartition(5), 4, 42, 1).collect()}
    other = {r["doc_id"]: r["batch"] for r in softmax.minibatches(df, 4, 42, 2).collect()}
    assert one == again != other
    assert sorted(one.values()) == [0] * 4 + [1] * 4 + [2] * 2


def test_work_dir_follows_the_session(spark, monkeypatch):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert session.work_dir(spark) == configured.rstrip("/")
    else:
        assert session.work_dir(spark) == session.work_dir(spark)


def test_spread_leaves_wide_inputs_alone(spark):
    wide = spark.range(100).repartition(16).withColumnRenamed("id", "doc_id")
    assert session.spread(wide, "doc_id") is wide
    assert session.spread(wide.coalesce(1), "doc_id").rdd.getNumPartitions() == 8


def test_written_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_written", [])
    df = session.materialise(spark.range(5))
    folder = df.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert df.count() == 5 and os.path.isdir(folder)
    assert session.drop_written(spark) == 1 and not os.path.isdir(folder)
    kept = session.materialise(spark.range(3))
    with session.written_here() as mine:
        session.materialise(spark.range(4))
    assert len(mine) == 1 and session.drop_tables(spark, mine) == 1 and not mine
    assert kept.count() == 3 and len(session._written) == 1
