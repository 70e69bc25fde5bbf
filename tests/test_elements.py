from collections import Counter

from pyspark.sql import functions as F

from textspark.operators import elements, segment, vocab


def test_a_chunk_sends_a_distinct_element_once(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, None), (4, ["b", None, "a"])], "doc_id long, tokens array<string>")
    rows = elements.chunked(docs.coalesce(1), "tokens").collect()
    assert Counter(r["element"] for r in rows if r["size"] is None) == Counter(["a", "b", None])
    assert {r["key"]: r["size"] for r in rows if r["size"] is not None} == {1: 3, 2: 0, 3: 0, 4: 3}
    assert next(r["at"] for r in rows if r["element"] == "a") == [0, 2, 3]


def test_chunks_of_any_size_encode_alike(spark, monkeypatch):
    docs = spark.createDataFrame([(i, [f"w{(i * 7 + j * j) % 13}" for j in range(i % 9)]) for i in range(40)], "doc_id long, tokens array<string>")
    known = vocab.build_vocab(docs.where("doc_id % 3 > 0"))
    ids = {r["term"]: r["id"] for r in known.collect()}
    want = {r["doc_id"]: [ids.get(t, 1) for t in r["tokens"]] for r in docs.collect()}
    for size in (1, 7, 1 << 19):
        monkeypatch.setattr(elements, "CHUNK", size)
        for limit in (0, 1 << 20):
            assert {r["doc_id"]: r["ids"] for r in vocab.encode(docs, known, limit=limit).collect()} == want


def test_rows_of_one_key_are_one_document(spark):
    docs = spark.createDataFrame([(1, ["b", "a"]), (1, ["c"]), (None, ["a"]), (None, ["a"]), (2, ["c", "c"])], "doc_id long, tokens array<string>")
    got = {r["doc_id"]: r["ids"] for r in vocab.encode(docs, vocab.build_vocab(docs)).collect()}
    assert got == {1: [3, 4, 2], None: [2, 2], 2: [4, 4]}


def test_no_join_by_token_and_document(spark):
    """A frequent token of many documents is one row of a chunk, not one row of each document."""
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.array(F.lit("中文"), F.lit(" "), F.lit("x")).alias("tokens")).coalesce(1)
    assert elements.chunked(docs, "tokens").where("size is null").count() == 3
    texts = docs.select("doc_id", F.array_join("tokens", "").alias("sentence_sep"))
    cut = segment.tokenize_dict(texts, spark.createDataFrame([("中文",)], "term string"), raw=True)
    assert cut.where(F.col("tokens") == F.array(F.lit("中文"), F.lit(" "), F.lit("x"))).count() == 500


def test_texts_are_cut_once(spark, monkeypatch):
    """Frequencies of runs come from the written chunks, not from a second pass over the texts."""
    reads, cut_up = spark.sparkContext.accumulator(0), segment.chunked

    @F.udf("string")
    def read(text):
        reads.add(1)
        return text

    monkeypatch.setattr(segment, "chunked", lambda *a: chunks.append(cut_up(*a)) or chunks[-1])
    chunks = []
    docs = spark.createDataFrame([(1, "中文中文x中"), (2, "中文 中"), (3, None)], "doc_id long, t string")
    texts = docs.select("doc_id", read.asNondeterministic()("t").alias("sentence_sep"))
    got = segment.tokenize_dict(texts, spark.createDataFrame([("中文",)], "term string"), raw=True).collect()
    assert {r["doc_id"]: r["tokens"] for r in got} == {1: ["中文", "中文", "x", "中"], 2: ["中文", " ", "中"], 3: []}
    assert len(chunks) == 1 and reads.value == 3
