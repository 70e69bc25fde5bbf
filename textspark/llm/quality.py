"""Quality rules by weak supervision: rules vote or abstain, EM finds their accuracies, a posterior decides."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.llm.common import BLANKS, quoted, without
from textspark.session import materialise

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_function", "n_ends"]

# Frequent function words of the languages a corpus is expected to hold.
FUNCTION_WORDS = [
    "a", "and", "are", "as", "by", "for", "in", "is", "it", "of", "on", "that", "the", "to", "was", "with",
    "das", "der", "die", "ein", "für", "ist", "mit", "nicht", "und", "von", "zu",
    "avec", "dans", "des", "du", "est", "et", "la", "le", "les", "que", "un", "une",
    "con", "de", "el", "en", "los", "para", "por", "se", "y",
]

_POSITION_BITS = 28  # a text has fewer words than 2^28: it is one string of at most 2 GiB

PRIOR_GOOD, PRIOR_ACCURACY, PRIOR_VOTES = 0.8, 0.85, 10.0  # start of EM, and pseudo-votes behind it
MOST_ACCURATE = 0.95  # no rule alone outvotes the others, such as function words on a language not listed
ROUNDS, SETTLED = 50, 1e-6


def _replaced(text: Column, new: str, blanks: str) -> Column:
    for b in blanks:
        text = F.replace(text, F.lit(b), F.lit(new))
    return text


def measured(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` and the measures of each text, in JVM expressions within the row.

    Three-word windows are compared by hash: sorted once as plain numbers of 36 hash bits and the
    position, then, where those agree, by the full 64 bits. So the cost is that of one sort per text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    flat = _replaced(F.col("_text"), " ", BLANKS[1:])
    words = F.array_remove(F.split(flat, " "), "")
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    window = lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))
    mask = (1 << _POSITION_BITS) - 1
    packed = F.transform(
        F.when(F.size("_w") < 4, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.size("_w") - 3)),
        lambda i: window(i).bitwiseAND(F.lit(~mask)).bitwiseOR(i),
    )

    def alike(sorted_: Column, top) -> Column:
        return F.filter(
            sorted_,
            lambda x, i: F.coalesce(top(x) == top(F.get(sorted_, i + 1)), F.lit(False))
            | F.coalesce(top(x) == top(F.get(sorted_, i - 1)), F.lit(False)),
        )

    exact = F.sort_array(
        F.transform("_near", lambda x: F.struct(window(x.bitwiseAND(F.lit(mask)).cast("int")).alias("h"), x.bitwiseAND(F.lit(mask)).alias("p")))
    )
    spread = F.aggregate(
        "_found",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("p")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3).cast("long"), p - acc["p"])).alias("n"), p.alias("p")),
        lambda acc: acc["n"],
    )
    kept = [c for c in ("_row",)]
    return (
        docs.select(F.struct(*keep).alias("_row"), text.alias("_text"))
        .select(
            *kept,
            "_text",
            words.alias("_w"),
            lines.alias("_lines"),
            F.length(_replaced(F.col("_text"), "", BLANKS)).cast("long").alias("word_chars"),
            F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            F.regexp_count("_text", F.lit("[.!?](?=[\\x20\\x09-\\x0D]|\\z)")).cast("long").alias("n_ends"),
        )
        .select(
            *kept,
            "_w",
            "word_chars",
            "n_symbols",
            "n_ends",
            F.size("_w").cast("long").alias("n_words"),
            F.size("_lines").cast("long").alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.size(F.filter("_w", lambda x: F.lower(x).isin(FUNCTION_WORDS))).cast("long").alias("n_function"),
            F.sort_array(packed).alias("_sorted"),
        )
        .withColumn("_near", alike(F.col("_sorted"), lambda x: F.shiftright(x, _POSITION_BITS)))
        .drop("_sorted")
        .withColumn("_exact", exact)
        .drop("_near", "_w")
        .withColumn("_found", F.sort_array(F.transform(alike(F.col("_exact"), lambda x: x["h"]), lambda x: x["p"])))
        .drop("_exact")
        .withColumn("n_repeat_words", F.when(F.size("_found") > 0, spread).otherwise(F.lit(0).cast("long")))
        .select("_row.*", *MEASURES)
    )


def _vote(bad: Column, good: Column | None = None) -> Column:
    """-1, 1 or 0 (abstains)."""
    vote = F.when(bad, -1)
    return (vote.when(good, 1) if good is not None else vote).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes from the measures. A rule votes for a text only on evidence of prose, never on the mere lack of a fault."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols": _vote(F.col("n_symbols") > 0.1 * n, F.col("n_symbols") <= 0.02 * n),
        "symbols_everywhere": _vote(F.col("n_symbols") > 0.5 * n),
        "function_words": _vote(F.col("n_function") < 0.05 * n, F.col("n_function") >= 0.1 * n),
        "sentences": _vote(F.col("n_ends") * 200 < n, (F.col("n_ends") * 50 >= n) & (F.col("n_ends") * 2 <= n)),
        "word_length": _vote((F.col("word_chars") < 2.5 * n) | (F.col("word_chars") > 12 * n)),
        "repeated_windows": _vote(F.col("n_repeat_words") > 0.3 * n),
        "repeated_lines": _vote(F.col("n_dup_lines") > 0.3 * F.col("n_lines")),
        "short": _vote(F.col("n_words") < 20),
    }


def _posterior(accuracy: dict[str, float], good: float) -> Column:
    """P(good | votes): the log odds add up, an abstaining rule adds nothing."""
    odds = F.lit(math.log(good / (1 - good)))
    for name, a in accuracy.items():
        odds = odds + F.col(f"_{name}") * math.log(a / (1 - a))
    return 1 / (1 + F.exp(-odds))


def fit_votes(votes: DataFrame, names: list[str]) -> tuple[dict[str, float], float]:
    """Accuracy of each rule and share of good texts by expectation-maximisation, without labels.

    Documents enter as counts of vote patterns, at most three to the power of the rules, pre-aggregated
    over the whole table; each round is one aggregate over the patterns. A rule is right with the same
    probability on good and on bad texts; pseudo-votes keep rules that hardly vote at the start value.
    """
    columns = [f"_{n}" for n in names]
    patterns = materialise(votes.groupBy(*columns).agg(F.count("*").alias("__n")).coalesce(1))
    accuracy, good = dict.fromkeys(names, PRIOR_ACCURACY), PRIOR_GOOD
    for _ in range(ROUNDS):
        p = patterns.withColumn("__p", _posterior(accuracy, good))
        sums = [F.sum(F.col("__n") * F.col("__p")).alias("__good"), F.sum("__n").alias("__all")]
        for c in columns:
            right = F.when(F.col(c) == 1, F.col("__p")).when(F.col(c) == -1, 1 - F.col("__p")).otherwise(0.0)
            sums += [F.sum(F.col("__n") * right).alias(f"r{c}"), F.sum(F.when(F.col(c) != 0, F.col("__n")).otherwise(0)).alias(f"v{c}")]
        got = p.agg(*sums).first()
        if not got["__all"]:
            break
        new = {
            n: min(MOST_ACCURATE, max(0.51, (got[f"r_{n}"] + PRIOR_ACCURACY * PRIOR_VOTES) / (got[f"v_{n}"] + PRIOR_VOTES))) for n in names
        }
        share = min(0.99, max(0.01, (got["__good"] + PRIOR_GOOD * PRIOR_VOTES) / (got["__all"] + PRIOR_VOTES)))
        moved = max(abs(share - good), *(abs(new[n] - accuracy[n]) for n in names))
        accuracy, good = new, share
        if moved < SETTLED:
            break
    return accuracy, good


def judged(docs: DataFrame, keep: list[str] | None = None, least: float = 0.5) -> DataFrame:
    """Columns of ``docs`` with the measures, ``base_failed``, ``quality`` (posterior) and ``kept``.

    A text fails the base with under 50 words or with more than half of its words in repeated windows;
    else it is kept if its posterior reaches ``least``. The fit uses the votes of all
    texts that pass the base. A null
    or empty text has zero measures and fails. Ties can't arise: each row is judged alone and equal
    texts alike. Columns with the names of results are replaced. An empty table stays empty.
    """
    docs = without(docs, *MEASURES, "base_failed", "quality", "kept", "_text", "_w", "_row")
    cols = [quoted(c) for c in (keep or docs.columns)]
    votes = rules()
    facts = materialise(measured(docs, cols))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    facts = facts.withColumns({f"_{n}": v for n, v in votes.items()} | {"base_failed": failed})
    accuracy, good = fit_votes(facts.where(~F.col("base_failed")), list(votes))
    return (
        facts.withColumn("quality", _posterior(accuracy, good))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
        .drop(*[f"_{n}" for n in votes])
    )
