import pytest
from pyspark.sql import functions as F

from textspark.functions import text
from textspark.operators.vocab import bag_of_terms


def apply(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r["x"] for r in df.select("i", make(F.col("s")).alias("x")).orderBy("i").collect()]


def test_clean_text(spark):
    given = ["您好[SEP]请帮我查话费！", "Hello, [sep] wörld  42", "[SEP]", "　你好　", None, "![Sep]!a[sep"]
    want = ["您好 请帮我查话费", "Hello w rld 42", "", "你好", "", "a sep"]
    assert apply(spark, given, text.clean_text) == want


def test_null_token(spark):
    assert apply(spark, [None], lambda c: text.clean_text(c, "nan")) == ["nan"]


def test_clean_text_survives_long_junk(spark):
    assert apply(spark, ["!" * 200_000 + "a"], text.clean_text) == ["a"]


def test_tokenize_modes(spark):
    given = ["您好abc话费吗 X1", ""]
    assert apply(spark, given, lambda c: text.tokenize(c, "char", False)) == [
        ["您", "好", "abc", "话", "费", "吗", "X1"],
        [],
    ]
    assert apply(spark, given, lambda c: text.tokenize(c, "bigram", False)) == [
        ["您好", "abc", "话费", "费吗", "X1"],
        [],
    ]
    assert apply(spark, given, text.tokenize) == [["abc", "话", "费", "X1"], []]


def test_unknown_han_mode():
    with pytest.raises(ValueError, match="han_mode"):
        text.tokenize("s", "words")


def test_stop_words_are_distinct_and_case_sensitive(spark):
    assert len(set(text.STOP_WORDS)) == len(text.STOP_WORDS) == 57
    got = apply(spark, ["a A b"], lambda c: text.drop_stop_words(F.split(c, " "), ("a",)))
    assert got == [["A", "b"]]


def test_tokenize_raw_keeps_everything(spark):
    given = ["a1, b\n您好", "😀x"]
    assert apply(spark, given, text.tokenize_raw) == [["a1", ",", " ", "b", "\n", "您", "好"], ["😀", "x"]]


def test_word_ngrams(spark):
    assert apply(spark, ["a b c", "a", ""], lambda c: text.word_ngrams(c, 1, 2)) == [
        ["a", "b", "c", "a b", "b c"],
        ["a"],
        [],
    ]


def test_char_ngrams(spark):
    assert apply(spark, ["ab c", "a"], lambda c: text.char_ngrams(c, 2, 3)) == [
        ["ab", "b ", " c", "ab ", "b c"],
        [],
    ]


def word_bounded(s, lo, hi):
    """The definition, letter by letter."""
    out = []
    for n in range(lo, hi + 1):
        for word in s.split():
            w = f" {word} "
            if len(w) > n:
                out += [w[i : i + n] for i in range(len(w) - n + 1)]
            elif len(w) == n or n == lo:
                out.append(w)
    return out


@pytest.mark.parametrize("span", [(2, 5), (1, 3), (4, 6), (5, 5), (6, 8)])
def test_char_wb_ngrams(spark, span):
    given = ["ab", "a", "中文", "hello a bc", "", "abcdefgh i"]
    got = apply(spark, given, lambda c: text.char_wb_ngrams(c, *span))
    assert [sorted(g) for g in got] == [sorted(word_bounded(s, *span)) for s in given]


def test_bad_range():
    with pytest.raises(ValueError, match="range"):
        text.word_ngrams(F.col("s"), 2, 1)


def test_counted(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, ["c"])], "doc_id long, tokens array<string>")
    rows = bag_of_terms(df).collect()
    assert sorted(map(tuple, rows)) == [(1, "a", 1), (1, "b", 2), (3, "c", 1)]


def test_counting_needs_no_shuffle_and_no_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bag = bag_of_terms(docs.select("doc_id", text.tokenize("text").alias("tokens")))
    plan = bag._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("regexp_extract_all") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
