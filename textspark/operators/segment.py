"""Dictionary segmentation, by longest match or by the most probable path, as joins over distinct runs of text."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.functions.text import HAN, STOP_WORDS, TURN_MARKER, as_text, drop_stop_words
from textspark.operators.elements import chunked, lookup_elements
from textspark.operators.lookup import BROADCAST_BYTES, fits, lookup
from textspark.operators.unnest import unnest_values
from textspark.session import materialise


MICRO = 1_000_000  # log-probabilities are whole millionths, so sums and ties are exact


def _spans(runs: DataFrame, lengths: list[int], keep: list[str]) -> DataFrame:
    """``run, at, n, term``: what stands at every position of a run in each of the lengths."""
    starts = unnest_values(runs, keep, F.sequence(F.lit(1), F.length("run")), "at")
    room = F.length("run") - F.col("at") + 1
    sizes = F.filter(F.array(*[F.lit(x) for x in sorted(lengths)]).cast("array<int>"), lambda x: x <= room)
    spans = unnest_values(starts, [*keep, "at"], sizes, "n")
    return spans.withColumn("term", F.col("run").substr(F.col("at"), F.col("n")))


def _found(spans: DataFrame, words: DataFrame, how: str, limit: int) -> DataFrame:
    """Spans with what ``words`` says of them; too many words are joined by shuffle, hot spans salted."""
    if fits(words, limit):
        return spans.join(F.broadcast(words), "term", how)
    freq = spans.groupBy("term").agg(F.count("*").alias("_spans"))
    return lookup(spans, materialise(freq.join(words, "term")), "term", how, "_spans", limit).drop("_spans")


def word_frequencies(
    df: DataFrame, dictionary: DataFrame, source: str = "sentence_sep", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``(term, freq)``: how often each dictionary word, and each single character, stands in the Han runs of a corpus.

    Every position counts, so words inside each other count all. As a dictionary the table makes
    segmentation take the best path instead of the longest match.
    """
    runs = F.regexp_extract_all(as_text(source), F.lit(f"[{HAN}]+"), F.lit(0))
    counted = unnest_values(df, [], runs, "run").groupBy("run").agg(F.count("*").alias("times"))
    return run_frequencies(counted, dictionary, limit)


def run_frequencies(counted: DataFrame, dictionary: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The same for distinct runs ``(run, times)``."""
    words = materialise(dictionary.select("term").distinct().where(F.length("term") > 1))
    lengths = [r[0] for r in words.select(F.length("term")).distinct().collect()]  # of words, so few
    spans = _spans(counted, [1, *lengths], ["run", "times"]).groupBy("term").agg(F.sum("times").alias("freq"))
    known = spans.join(words, "term", "left_semi")
    return materialise(known.unionByName(spans.where(F.length("term") == 1)))


def _best_cuts(runs: DataFrame, dictionary: DataFrame, limit: int) -> DataFrame:
    """``(run, cuts)``: where the pieces of the most probable path through the lattice of words begin.

    From the last position back, the best path from a position is the best of its words followed by the
    best path from behind it; of equal ones the longer word.
    """
    given = materialise(dictionary.groupBy("term").agg(F.sum("freq").alias("freq")).where("term <> '' and freq > 0"))
    total = float(given.agg(F.sum("freq")).first()[0] or 1)
    cost = F.round(F.log(F.col("freq") / total) * MICRO).cast("bigint").alias("cost")
    words = materialise(given.select("term", cost))
    lengths = {r[0] for r in words.select(F.length("term")).distinct().collect()}
    unknown = round(math.log(1 / total) * MICRO)
    lattice = _found(_spans(runs, sorted({1, *lengths}), ["run"]), words, "left", limit)
    lattice = lattice.where((F.col("n") == 1) | F.col("cost").isNotNull())
    word = F.struct(F.coalesce("cost", F.lit(unknown)).alias("cost"), "n")
    at = lattice.groupBy("run", "at").agg(F.collect_list(word).alias("words"))
    rows = at.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("at", "words")), asc=False).alias("back"))

    def behind(path: Column, words: Column) -> Column:
        zero = F.lit(0).cast("bigint")
        ways = F.transform(words, lambda w: F.struct((w["cost"] + F.coalesce(F.get(path, w["n"] - 1)["cost"], zero)).alias("cost"), w["n"].alias("n")))
        return F.concat(F.array(F.array_max(ways)), path)

    none = F.array().cast("array<struct<cost:bigint,n:int>>")
    paths = materialise(rows.select("run", F.aggregate("back", none, lambda path, p: behind(path, p["words"])).alias("path")))
    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("cuts"))

    def walk(acc: Column, i: Column) -> Column:
        piece = F.get(F.col("path"), i - 1)["n"]
        taken = F.struct((i + piece).alias("next"), F.concat(acc["cuts"], F.array(i)).alias("cuts"))
        return F.when(acc["next"] == i, taken).otherwise(acc)

    return paths.select("run", F.aggregate(F.sequence(F.lit(1), F.size("path")), start, walk, lambda acc: acc["cuts"]).alias("cuts"))


def segment_runs(
    runs: DataFrame, dictionary: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``(run, pieces array<string>)`` for distinct, non-empty runs.

    With a ``dictionary`` of ``term`` alone, from each position the longest word is taken, a single
    character if none starts there. With ``term, freq`` (see ``word_frequencies``) the pieces are those of
    the path through all words with the highest product of relative frequencies, where a character that is
    no term counts once; of equal paths the one with the longer word first. Only lengths that occur are probed.
    """
    if "freq" in dictionary.columns:
        return _pieces(_best_cuts(runs, dictionary, limit))
    words = materialise(dictionary.select("term").distinct().where(F.length("term") > 1))
    lengths = [r[0] for r in words.select(F.length("term")).distinct().collect()]  # of words, so few
    hits = _found(_spans(runs, lengths, ["run"]), words, "inner", limit)
    best = hits.groupBy("run", "at").agg(F.max("n").alias("n"))
    matches = best.groupBy("run").agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("matches"))
    planned = runs.join(matches, "run", "left")

    none = F.array().cast("array<int>")

    def singles(first: Column, last: Column) -> Column:
        return F.when(last >= first, F.sequence(first, last)).otherwise(none)

    def take(acc: Column, m: Column) -> Column:
        # Matches come by position; one that starts inside the last piece is passed over.
        taken = F.struct(
            (m["at"] + m["n"]).alias("next"),
            F.concat(acc["cuts"], singles(acc["next"], m["at"] - 1), F.array(m["at"])).alias("cuts"),
        )
        return F.when(m["at"] >= acc["next"], taken).otherwise(acc)

    cuts = F.aggregate(
        F.coalesce("matches", F.array().cast("array<struct<at:int,n:int>>")),
        F.struct(F.lit(1).alias("next"), none.alias("cuts")),
        take,
        lambda acc: F.concat(acc["cuts"], singles(acc["next"], F.length("run"))),
    )
    return _pieces(planned.select("run", cuts.alias("cuts")))


def _pieces(placed: DataFrame) -> DataFrame:
    ends = F.concat(F.slice("cuts", F.lit(2), F.size("cuts")), F.array(F.length("run") + 1))
    pieces = F.zip_with("cuts", ends, lambda a, b: F.col("run").substr(a, b - a))
    return placed.select("run", pieces.alias("pieces"))


def tokenize_dict(
    df: DataFrame,
    dictionary: DataFrame,
    source: str = "sentence_sep",
    key: str = "doc_id",
    raw: bool = False,
    remove_stopwords: bool = False,
    stop_words: Sequence[str] = STOP_WORDS,
    null_token: str = "",
) -> DataFrame:
    """``(key, tokens)`` with Han runs cut by the dictionary and ASCII runs kept whole.

    A dictionary with a column ``freq`` cuts by the most probable path, others by longest match.
    Each distinct Han run is segmented once, however often it occurs. ``raw`` keeps turn markers, and
    every other character, blanks included, as a token of its own. ``null_token`` stands for a missing text.
    """
    text = as_text(source, null_token)
    if not raw:
        text = F.regexp_replace(text, TURN_MARKER, " ")
    pattern = f"[a-zA-Z0-9]+|[{HAN}]+" + (r"|[\s\S]" if raw else "")
    runs = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    chunks = chunked(df, runs, key)  # the only time the texts are read
    placed = chunks.where("size is null").select(F.col("element").alias("run"), F.size("at").alias("times"))
    han = placed.where(F.col("run").rlike(f"^[{HAN}]"))
    freq = materialise(han.groupBy("run").agg(F.sum("times").alias("freq")))
    cut = materialise(segment_runs(freq.select("run"), dictionary).join(freq, "run"))
    found = lookup_elements(df, runs, cut, "run", F.coalesce("pieces", F.array("run")), "tokens", key, "freq", chunks=chunks)
    found = found.withColumn("tokens", F.flatten("tokens"))
    return found.withColumn("tokens", drop_stop_words(F.col("tokens"), stop_words)) if remove_stopwords else found
