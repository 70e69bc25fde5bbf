"""Queries over text: cleaning, tokens, n-grams, segmentation, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from textspark.functions.text import (
    STOP_WORDS,
    clean_text,
    drop_stop_words,
    tokenize,
    tokenize_raw,
)
from textspark.operators.features import with_text
from textspark.operators.gram_stats import gram_stats
from textspark.operators.segment import run_frequencies, segment_runs
from textspark.operators.unnest import unnest_values
from textspark.operators.vocab import bag_of_terms, token_freq
from textspark.registry import sql
from textspark.session import materialise
from textspark.sources.tables import dialog_turns, documents, table

MORE_STOP_WORDS = ("the", "of", "and", "la", "de", "und")


def _split_load(spark, sf):
    return documents(spark, sf).select("doc_id", "ID", "label_raw", "split", F.length("sentence_sep").cast("bigint").alias("chars"))


def _split_stats(spark, sf):
    docs = documents(spark, sf)
    counts = docs.groupBy("split").agg(
        F.count("*").alias("documents"), F.countDistinct("label_raw").alias("classes")
    )
    terms = unnest_values(with_text(docs), ["split"], F.array_distinct(F.split("text", " ")), "term")
    sizes = terms.where("term <> ''").distinct().groupBy("split").agg(F.count("*").alias("vocab_size"))
    return counts.join(sizes, "split", "left").withColumn("vocab_size", F.coalesce("vocab_size", F.lit(0)))


def _clean_text(spark, sf):
    return documents(spark, sf).select("doc_id", clean_text("sentence_sep").alias("cleaned"))


def _clean_turns(spark, sf):
    return dialog_turns(spark, sf).select("conv_id", "turn", clean_text("sentence_sep").alias("cleaned"))


def _tokenize(spark, sf):
    tokens = documents(spark, sf).select("doc_id", tokenize("sentence_sep").alias("tokens"))
    return tokens.select(
        "doc_id", F.size("tokens").cast("bigint").alias("n"), F.array_join("tokens", " ").alias("joined")
    )


def _tokenize_raw(spark, sf):
    tokens = documents(spark, sf).select("doc_id", tokenize_raw("sentence_sep").alias("tokens"))
    return tokens.select(
        "doc_id", F.size("tokens").cast("bigint").alias("n"), F.md5(F.array_join("tokens", "|")).alias("digest")
    )


def _stopword_filter(spark, sf):
    kept = drop_stop_words(tokenize("sentence_sep", remove_stopwords=False), STOP_WORDS + MORE_STOP_WORDS)
    return token_freq(documents(spark, sf).select("doc_id", kept.alias("tokens")))


def _token_freq(spark, sf):
    return token_freq(documents(spark, sf).select("doc_id", tokenize("sentence_sep").alias("tokens")))


def _gram_stats(method, lo, hi):
    def query(spark, sf):
        return gram_stats(with_text(documents(spark, sf)), method, lo, hi)

    return query


SEGMENT_MIN_FREQ = 30


def _corpus_dictionary(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Every distinct lower-case word ``term, freq``, and the frequent ones."""
    texts = with_text(documents(spark, sf)).select("doc_id", F.split("text", " ").alias("tokens"))
    freq = materialise(token_freq(texts).where("term <> ''"))
    return freq, freq.where(F.col("freq") >= SEGMENT_MIN_FREQ).select("term")


def _segment_dict(spark, sf):
    """Cut every distinct lower-case word by a dictionary of the corpus' frequent words."""
    freq, dictionary = _corpus_dictionary(spark, sf)
    cut = segment_runs(freq.select(F.col("term").alias("run")), dictionary)
    return cut.select("run", F.array_join("pieces", " ").alias("pieces"))


def _segment_best(spark, sf):
    """The same by the most probable path, with frequencies of the dictionary's words inside all words."""
    freq, dictionary = _corpus_dictionary(spark, sf)
    runs = freq.select(F.col("term").alias("run"), F.col("freq").alias("times"))
    cut = segment_runs(runs.select("run"), run_frequencies(runs, dictionary))
    return cut.select("run", F.array_join("pieces", " ").alias("pieces"))


def _benchmark_tokens(spark, sf):
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), tokenize("text").alias("tokens"))
    return bag_of_terms(items).withColumnRenamed("doc_id", "item_id")


QUERIES = {
    "split_load": _split_load,
    "split_stats": _split_stats,
    "clean_text": _clean_text,
    "clean_turns": _clean_turns,
    "tokenize": _tokenize,
    "tokenize_raw": _tokenize_raw,
    "stopword_filter": _stopword_filter,
    "token_freq": _token_freq,
    "word_ngrams": _gram_stats("ngram", 1, 2),
    "char_ngrams": _gram_stats("char_tfidf", 2, 3),
    "char_wb_ngrams": _gram_stats("char_wb_tfidf", 2, 5),
    "segment_dict": _segment_dict,
    "segment_best": _segment_best,
    "benchmark_tokens": _benchmark_tokens,
}

_TOKENS = "regexp_extract_all({x}, '[a-zA-Z0-9]+|[一-龥]')"
_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS + MORE_STOP_WORDS)
_REFERENCE_TOKENS = f"""WITH t AS (
  SELECT doc_id, unnest({_TOKENS.format(x=sql.clean('text'))}) AS term FROM documents)"""

ORACLES = {
    "split_load": f'WITH {sql.DOCS} SELECT doc_id, "ID", label_raw, split, length(sentence_sep) AS chars FROM docs',
    "split_stats": f"""{sql.TEXT}
        SELECT d.split, count(*) AS documents, count(DISTINCT label_raw) AS classes,
               (SELECT count(DISTINCT term) FROM words w WHERE w.split = d.split) AS vocab_size
        FROM docs d GROUP BY d.split""",
    "clean_text": f"SELECT doc_id, {sql.clean('text')} AS cleaned FROM documents",
    "clean_turns": f"""SELECT conv_id, turn, {sql.clean("text || ' [SEP] '")} AS cleaned FROM conversations""",
    "tokenize": f"""SELECT doc_id, len(t) AS n, array_to_string(t, ' ') AS joined
        FROM (SELECT doc_id, {_TOKENS.format(x=sql.clean('text'))} AS t FROM documents)""",
    "tokenize_raw": """SELECT doc_id, len(t) AS n, md5(array_to_string(t, '|')) AS digest
        FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9]+|[\\s\\S]') AS t FROM documents)""",
    "stopword_filter": f"""{_REFERENCE_TOKENS}
        SELECT term, count(*) AS freq FROM t WHERE term NOT IN ({_STOPS}) GROUP BY term""",
    "token_freq": f"{_REFERENCE_TOKENS} SELECT term, count(*) AS freq FROM t GROUP BY term",
    "word_ngrams": f"{sql.TEXT}, grams AS ({sql.word_grams(1, 2)}) " + sql.STATS.format(grams="grams"),
    "char_ngrams": f"{sql.TEXT}, grams AS ({sql.char_grams(2, 3)}) " + sql.STATS.format(grams="grams"),
    "char_wb_ngrams": f"{sql.TEXT}, grams AS ({sql.char_wb_grams(2, 5)}) " + sql.STATS.format(grams="grams"),
    "segment_dict": f"""WITH RECURSIVE {sql.DOCS}, {sql.CLEANED}, {sql.WORDS},
        freq AS (SELECT term, count(*) AS n FROM words GROUP BY term),
        dict AS (SELECT term FROM freq WHERE n >= {SEGMENT_MIN_FREQ}
                 AND length(term) > 1),
        longest AS (SELECT coalesce(max(length(term)), 0) AS most FROM dict),
        spans AS (SELECT run, i, CAST(unnest(range(2, least(most, length(run) - i + 1) + 1)) AS BIGINT) AS n
                  FROM longest, (SELECT term AS run, CAST(unnest(range(1, length(term) + 1)) AS BIGINT) AS i FROM freq)),
        best AS (SELECT run, i, max(n) AS n FROM spans JOIN dict ON dict.term = substr(run, i, n) GROUP BY run, i),
        walk(run, i, pieces) AS (
          SELECT term, CAST(1 AS BIGINT), '' FROM freq
          UNION ALL
          SELECT w.run, w.i + coalesce(b.n, 1), w.pieces || ' ' || substr(w.run, w.i, coalesce(b.n, 1))
          FROM walk w LEFT JOIN best b ON b.run = w.run AND b.i = w.i WHERE w.i <= length(w.run))
        SELECT run, trim(pieces) AS pieces FROM walk WHERE i > length(run)""",
    "segment_best": f"""WITH RECURSIVE {sql.DOCS}, {sql.CLEANED}, {sql.WORDS},
        runs AS (SELECT term AS run, count(*) AS times FROM words GROUP BY term),
        dict AS (SELECT run AS term FROM runs WHERE times >= {SEGMENT_MIN_FREQ} AND length(run) > 1),
        longest AS (SELECT greatest(coalesce(max(length(term)), 1), 1) AS most FROM dict),
        spans AS (SELECT run, times, i, n, substr(run, i, n) AS term FROM (
                  SELECT run, times, i, CAST(unnest(range(1, least(most, length(run) - i + 1) + 1)) AS BIGINT) AS n
                  FROM longest, (SELECT run, times, CAST(unnest(range(1, length(run) + 1)) AS BIGINT) AS i FROM runs))),
        freq AS (SELECT term, sum(times) AS f FROM spans WHERE n = 1 OR term IN (SELECT term FROM dict) GROUP BY term),
        cost AS (SELECT term, CAST(round(ln(f / (SELECT sum(f)::DOUBLE FROM freq)) * 1000000) AS BIGINT) AS c FROM freq),
        lattice AS (SELECT run, i, list({{'c': c, 'n': n}}) AS ways FROM spans JOIN cost USING (term) GROUP BY run, i),
        path(run, i, best) AS (
          SELECT run, CAST(length(run) + 1 AS BIGINT), CAST([] AS STRUCT(c BIGINT, n BIGINT)[]) FROM runs
          UNION ALL
          SELECT p.run, p.i - 1, list_prepend(list_sort([{{'c': w.c + coalesce(p.best[w.n].c, 0), 'n': w.n}} FOR w IN l.ways], 'DESC')[1], p.best)
          FROM path p JOIN lattice l ON l.run = p.run AND l.i = p.i - 1),
        walk(run, i, best, pieces) AS (
          SELECT run, CAST(1 AS BIGINT), best, '' FROM path WHERE i = 1
          UNION ALL
          SELECT run, i + best[i].n, best, pieces || ' ' || substr(run, i, best[i].n) FROM walk WHERE i <= length(run))
        SELECT run, trim(pieces) AS pieces FROM walk WHERE i > length(run)""",
    "benchmark_tokens": f"""WITH t AS (
          SELECT item_id, unnest({_TOKENS.format(x=sql.clean('text'))}) AS term FROM benchmark)
        SELECT item_id, term, count(*) AS tf FROM t GROUP BY item_id, term""",
}
