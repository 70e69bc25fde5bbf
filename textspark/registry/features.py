"""Queries over vocabularies and features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.functions.text import tokenize_raw
from textspark.operators.features import df_band, smooth_idf, top_terms, weigh, with_text
from textspark.operators.rank import global_rank
from textspark.operators.vocab import bag_of_terms, build_vocab, encode, term_stats
from textspark.plans.extractor import FeatureExtractor, features_by_split
from textspark.registry import sql
from textspark.session import materialise
from textspark.sources.tables import documents

TOP, MIN_DF, MAX_DF, MIN_FREQ = 500, 5, 0.3, 2


def rounded(x):
    return F.round(x, 6) + F.lit(0.0)


def _bag(spark, sf) -> DataFrame:
    """Word counts of every document."""
    texts = with_text(documents(spark, sf)).select("doc_id", F.split("text", " ").alias("tokens"))
    return bag_of_terms(texts).where("term <> ''")


def raw_tokens(spark, sf) -> DataFrame:
    return documents(spark, sf).select("doc_id", "split", tokenize_raw("sentence_sep").alias("tokens"))


def raw_vocab(tokens: DataFrame, min_freq: int = 1) -> DataFrame:
    """Vocabulary of the train and dev documents."""
    return build_vocab(tokens.where("split in ('train', 'dev')"), min_freq=min_freq)


def _bow(spark, sf):
    return _bag(spark, sf)


def _stats(spark, sf):
    return term_stats(_bag(spark, sf))


def _df_band(spark, sf):
    return df_band(_stats(spark, sf), documents(spark, sf).count(), MIN_DF, MAX_DF)


def _idf(spark, sf):
    n = documents(spark, sf).count()
    return _stats(spark, sf).select("term", "df", rounded(smooth_idf(F.col("df"), n)).alias("idf"))


def _tfidf(spark, sf):
    n = documents(spark, sf).count()
    bag = _bag(spark, sf)
    terms = materialise(term_stats(bag).withColumn("idf", smooth_idf(F.col("df"), n)))
    weighed = weigh(bag, terms, weighted=True, sublinear=True)
    return weighed.withColumn("value", rounded(F.col("value")))


def _vocab_topk(spark, sf):
    top = top_terms(_stats(spark, sf), TOP)
    return global_rank(top.select("term", "tf"), ["term"], "term_id")


def _vocab_build(spark, sf):
    return raw_vocab(raw_tokens(spark, sf), MIN_FREQ)


def encoded(spark, sf, max_length=None, min_freq=1) -> DataFrame:
    tokens = raw_tokens(spark, sf)
    return encode(tokens, raw_vocab(tokens, min_freq), max_length=max_length)


def _digest(df):
    return df.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n"),
        F.md5(F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")).alias("digest"),
    )


def _encode_docs(spark, sf):
    return _digest(encoded(spark, sf))


def _encode_truncated(spark, sf):
    return _digest(encoded(spark, sf, max_length=350, min_freq=MIN_FREQ))


def _features_fit_transform(spark, sf):
    docs = documents(spark, sf)
    extractor = FeatureExtractor("tfidf", 2000, (1, 2), sublinear_tf=True).fit(docs)
    return extractor.transform_long(docs).withColumn("value", rounded(F.col("value")))


def _features_by_split(spark, sf):
    docs = documents(spark, sf)
    extractor = FeatureExtractor("char_wb_tfidf", 12000, (2, 5), sublinear_tf=True)
    vectors = features_by_split(extractor, docs)
    raw = F.unwrap_udt("features")
    values = F.transform(raw["values"], lambda v: v)
    weighted = F.zip_with(raw["indices"], raw["values"], lambda i, v: i * v)
    add = lambda xs: F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)
    return vectors.select(
        "doc_id",
        "split",
        F.size(raw["indices"]).cast("bigint").alias("nnz"),
        rounded(add(values)).alias("total"),
        F.round(add(weighted), 4).alias("moment"),
    )


METHODS = [
    ("bow", (1, 1), 500, 1, 1.0, False),
    ("ngram", (1, 2), 800, 2, 0.9, False),
    ("tfidf", (1, 2), 1000, 1, 1.0, False),
    ("char_tfidf", (2, 3), 600, 3, 0.95, True),
    ("char_wb_tfidf", (2, 5), 1200, 1, 1.0, True),
]


def _feature_methods(spark, sf):
    """Each method fitted on train and applied to all documents, summed up per document."""
    # Tokens are cut once, for each method reads them twice.
    docs = materialise(with_text(documents(spark, sf)).select("doc_id", "split", "text"))

    def one(method, span, top, min_df, max_df, sublinear):
        extractor = FeatureExtractor(method, top, span, min_df, max_df, sublinear).fit(docs.where("split = 'train'"))
        add = F.aggregate("features", F.lit(0.0), lambda acc, p: acc + p["value"])
        return extractor.transform_rows(docs).select(
            F.lit(method).alias("method"),
            "doc_id",
            F.lit(extractor.vocab_size).cast("bigint").alias("vocab_size"),
            F.size("features").cast("bigint").alias("nnz"),
            rounded(add).alias("total"),
        )

    return reduce(DataFrame.unionByName, [one(*m) for m in METHODS])


QUERIES = {
    "bow": _bow,
    "term_stats": _stats,
    "df_band": _df_band,
    "idf": _idf,
    "tfidf": _tfidf,
    "vocab_topk": _vocab_topk,
    "vocab_build": _vocab_build,
    "encode_docs": _encode_docs,
    "encode_truncated": _encode_truncated,
    "features_fit_transform": _features_fit_transform,
    "features_by_split": _features_by_split,
    "feature_methods": _feature_methods,
}

_BAG = "bag AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term)"
_STATS = "stats AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM bag GROUP BY term)"
_N = "(SELECT count(*) FROM documents)"
_IDF = f"ln((1.0 + {_N}) / (1 + df)) + 1"


def vocabulary(min_freq: int) -> str:
    """CTEs ``rawt(doc_id, split, pos, term)`` and ``vocab(term, id, freq)``."""
    extract = "regexp_extract_all(sentence_sep, '[A-Za-z0-9]+|[\\s\\S]')"
    return f"""{sql.DOCS},
    rawt AS (SELECT doc_id, split, unnest({extract}) AS term, generate_subscripts({extract}, 1) AS pos FROM docs),
    freqs AS (SELECT term, count(*) AS freq FROM rawt WHERE split IN ('train', 'dev')
              GROUP BY term HAVING count(*) >= {min_freq}),
    vocab AS (SELECT term, row_number() OVER (ORDER BY term) + 1 AS id, freq FROM freqs
              UNION ALL SELECT '<PAD>', 0, 0 UNION ALL SELECT '<UNK>', 1, 0)"""


def encoded_sql(min_freq: int = 1) -> str:
    """The CTEs above and ``enc(doc_id, pos, id)``."""
    return f"""{vocabulary(min_freq)},
    enc AS (SELECT doc_id, pos, coalesce(id, 1) AS id FROM rawt LEFT JOIN vocab USING (term))"""


def _encode_sql(min_freq: int, condition: str) -> str:
    return f"""WITH {encoded_sql(min_freq)}
        SELECT d.doc_id, count(e.id) AS n,
               md5(coalesce(string_agg(CAST(e.id AS VARCHAR), ',' ORDER BY e.pos), '')) AS digest
        FROM documents d LEFT JOIN (SELECT * FROM enc WHERE {condition}) e USING (doc_id) GROUP BY d.doc_id"""


def fitted(name: str, grams: str, top, min_df, max_df, sublinear, weighted, fit="split = 'train'") -> str:
    """CTEs that end in ``{name}(doc_id, term_id, value)`` and ``{name}_v`` (the vocabulary)."""
    n = f"(SELECT count(*) FROM docs WHERE {fit})"
    tf = "(1 + ln(tf))" if sublinear else "tf"
    value = f"{tf} * idf" if weighted else "CAST(tf AS DOUBLE)"
    norm = "/ sqrt(sum(v * v) OVER (PARTITION BY doc_id))" if weighted else ""
    return f"""{name}_b AS (SELECT doc_id, split, term, count(*) AS tf FROM ({grams}) GROUP BY ALL),
    {name}_s AS (SELECT term, sum(tf) AS tf, count(*) AS df FROM {name}_b WHERE {fit} GROUP BY term),
    {name}_t AS (SELECT term, df FROM {name}_s WHERE df >= {min_df} AND df <= {max_df} * {n}
                 ORDER BY tf DESC, term LIMIT {top}),
    {name}_v AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id,
                 ln((1.0 + {n}) / (1 + df)) + 1 AS idf FROM {name}_t),
    {name}_w AS (SELECT doc_id, term_id, {value} AS v FROM {name}_b JOIN {name}_v USING (term)),
    {name} AS (SELECT doc_id, term_id, v {norm} AS value FROM {name}_w)"""


_GRAMS = {
    "bow": sql.word_grams,
    "ngram": sql.word_grams,
    "tfidf": sql.word_grams,
    "char_tfidf": sql.char_grams,
    "char_wb_tfidf": sql.char_wb_grams,
}


def _methods_sql() -> str:
    ctes, parts = [], []
    for method, (lo, hi), top, min_df, max_df, sublinear in METHODS:
        name = f"m_{method}"
        weighted = method.endswith("tfidf")
        ctes.append(fitted(name, _GRAMS[method](lo, hi), top, min_df, max_df, sublinear, weighted))
        parts.append(
            f"""SELECT '{method}' AS method, d.doc_id, (SELECT count(*) FROM {name}_v) AS vocab_size,
            count(x.term_id) AS nnz, {sql.rounded('coalesce(sum(x.value), 0)')} AS total
            FROM documents d LEFT JOIN {name} x USING (doc_id) GROUP BY d.doc_id"""
        )
    return f"{sql.TEXT}, {', '.join(ctes)} " + " UNION ALL ".join(parts)


ORACLES = {
    "bow": f"{sql.TEXT}, {_BAG} SELECT * FROM bag",
    "term_stats": f"{sql.TEXT}, {_BAG}, {_STATS} SELECT * FROM stats",
    "df_band": f"{sql.TEXT}, {_BAG}, {_STATS} SELECT * FROM stats WHERE df >= {MIN_DF} AND df <= {MAX_DF} * {_N}",
    "idf": f"{sql.TEXT}, {_BAG}, {_STATS} SELECT term, df, {sql.rounded(_IDF)} AS idf FROM stats",
    "tfidf": f"""{sql.TEXT}, {_BAG}, {_STATS},
        w AS (SELECT doc_id, term, (1 + ln(bag.tf)) * ({_IDF}) AS v FROM bag JOIN stats USING (term))
        SELECT doc_id, term, {sql.rounded('v / sqrt(sum(v * v) OVER (PARTITION BY doc_id))')} AS value FROM w""",
    "vocab_topk": f"""{sql.TEXT}, {_BAG}, {_STATS},
        top AS (SELECT term, tf FROM stats ORDER BY tf DESC, term LIMIT {TOP})
        SELECT term, tf, row_number() OVER (ORDER BY term) - 1 AS term_id FROM top""",
    "vocab_build": f"WITH {vocabulary(MIN_FREQ)} SELECT term, id, freq FROM vocab",
    "encode_docs": _encode_sql(1, "true"),
    "encode_truncated": _encode_sql(MIN_FREQ, "pos <= 350"),
    "features_fit_transform": f"""{sql.TEXT},
        {fitted('x', sql.word_grams(1, 2), 2000, 1, 1.0, True, True, 'true')}
        SELECT doc_id, term_id, {sql.rounded('value')} AS value FROM x""",
    "features_by_split": f"""{sql.TEXT},
        {fitted('x', sql.char_wb_grams(2, 5), 12000, 1, 1.0, True, True)}
        SELECT d.doc_id, d.split, count(term_id) AS nnz, {sql.rounded('coalesce(sum(value), 0)')} AS total,
               round(coalesce(sum(term_id * value), 0), 4) AS moment
        FROM docs d LEFT JOIN x USING (doc_id) GROUP BY d.doc_id, d.split""",
    "feature_methods": _methods_sql(),
}
