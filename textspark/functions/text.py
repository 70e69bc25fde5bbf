"""Cleaning, tokenisation and n-gram expressions. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stop words.
STOP_WORDS = (
    "的", "了", "在", "是", "我", "有", "和", "就", "不", "人", "都", "一", "一个", "上", "也",
    "很", "到", "说", "要", "去", "你", "会", "着", "没有", "看", "好", "自己", "这", "那", "她",
    "他", "它", "们", "什么", "吗", "呢", "吧", "啊", "呀", "哦", "嗯", "哈", "嘛", "哎", "唉",
    "啦", "嘞", "哇", "哪", "这个", "那个", "请", "您", "帮", "一下", "还", "对",
)

TURN_MARKER = r"(?i)\[sep\]"
HAN = "一-龥"
HAN_MODES = ("char", "bigram")


def as_text(c: Column | str, null_token: str = "") -> Column:
    """Any value as a string; a missing one becomes ``null_token``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(null_token))


def clean_text(c: Column | str, null_token: str = "") -> Column:
    """Drop turn markers and everything but Han, ASCII letters and digits; one blank between runs."""
    unmarked = F.regexp_replace(as_text(c, null_token), TURN_MARKER, " ")
    # White space lies outside the kept class, so one pass also squeezes its runs.
    return F.trim(F.regexp_replace(unmarked, f"[^{HAN}a-zA-Z0-9]+", " "))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A plain reference inside a lambda would be inlined and recomputed per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _han_pairs(tokens: Column) -> Column:
    """Replace each Han run by its overlapping pairs; a lone character stays."""

    def expand(t: Column) -> Column:
        run = t.rlike(f"^[{HAN}]") & (F.length(t) > 1)
        pairs = F.transform(F.sequence(F.lit(1), F.length(t) - 1), lambda i: t.substr(i, F.lit(2)))
        return F.when(run, pairs).otherwise(F.array(t))

    return F.flatten(F.transform(tokens, expand))


def _check_mode(han_mode: str) -> None:
    if han_mode not in HAN_MODES:
        raise ValueError(f"unknown han_mode: {han_mode}; operators.segment.tokenize_dict cuts by a dictionary")


def drop_stop_words(tokens: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Case-sensitive removal of stop words and blank tokens."""
    return F.filter(tokens, lambda t: (F.trim(t) != "") & ~t.isin(*stop_words))


def tokenize(
    c: Column | str,
    han_mode: str = "char",
    remove_stopwords: bool = True,
    stop_words: Sequence[str] = STOP_WORDS,
    null_token: str = "",
) -> Column:
    """Tokens of the cleaned text: ASCII runs, and Han by character or pair."""
    _check_mode(han_mode)
    unmarked = F.regexp_replace(as_text(c, null_token), TURN_MARKER, " ")
    han = f"[{HAN}]" if han_mode == "char" else f"[{HAN}]+"
    # Extraction skips what cleaning would blank out, so cleaning itself is not needed here.
    tokens = F.regexp_extract_all(unmarked, F.lit(f"[a-zA-Z0-9]+|{han}"), F.lit(0))
    if han_mode == "bigram":
        tokens = _han_pairs(tokens)
    return drop_stop_words(tokens, stop_words) if remove_stopwords else tokens


def tokenize_raw(c: Column | str, han_mode: str = "char", null_token: str = "") -> Column:
    """Tokens of the text as it is; white space and punctuation are tokens, too. ``null_token`` stands for a missing text."""
    _check_mode(han_mode)
    if han_mode == "char":
        return F.regexp_extract_all(as_text(c, null_token), F.lit(r"[A-Za-z0-9]+|[\s\S]"), F.lit(0))
    return _han_pairs(F.regexp_extract_all(as_text(c, null_token), F.lit(rf"[A-Za-z0-9]+|[{HAN}]+|[\s\S]"), F.lit(0)))


def document_text(tokens: Column) -> Column:
    """The lower-cased, blank-joined form that the n-gram analysers read."""
    return F.lower(F.array_join(tokens, " "))


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _check_range(lo: int, hi: int) -> None:
    if not 1 <= lo <= hi:
        raise ValueError(f"bad n-gram range: ({lo}, {hi})")


def word_ngrams(text: Column, lo: int = 1, hi: int = 1) -> Column:
    """Word n-grams of a blank-joined text, each joined by a blank."""
    _check_range(lo, hi)
    return F.concat(
        *[_all(text, rf"(?<!\S)(?=(\S+(?: \S+){{{n - 1}}}))") for n in range(lo, hi + 1)]
    )


def char_ngrams(text: Column, lo: int = 1, hi: int = 1) -> Column:
    """Character n-grams over the whole text, blanks included."""
    _check_range(lo, hi)
    squeezed = F.regexp_replace(text, r"\s\s+", " ")
    return F.concat(*[_all(squeezed, rf"(?s)(?=(.{{{n}}}))") for n in range(lo, hi + 1)])


def char_wb_ngrams(text: Column, lo: int = 1, hi: int = 1) -> Column:
    """Character n-grams that stay inside one word padded with a blank on each side.

    A padded word shorter than ``lo`` still yields itself once.
    """
    _check_range(lo, hi)
    # Doubling the separators gives every word its own two blanks.
    padded = F.concat(F.lit(" "), F.regexp_replace(F.trim(text), r"\s+", "  "), F.lit(" "))

    def inside(n: int) -> str:
        if n == 1:
            return "([^ ]| )"
        forms = [f"[^ ]{{{n}}}", f" [^ ]{{{n - 1}}}", f"[^ ]{{{n - 1}}} "]
        if n > 2:
            forms.append(f" [^ ]{{{n - 2}}} ")
        return f"(?=({'|'.join(forms)}))"

    parts = [_all(padded, inside(n)) for n in range(lo, hi + 1)]
    if lo > 3:
        parts.append(_all(padded, f"( [^ ]{{1,{lo - 3}}} )"))
    return F.when(F.trim(text) == "", F.array().cast("array<string>")).otherwise(F.concat(*parts))


def _run_ends(ordered: Column) -> Column:
    """Positions, from 1, at which a run of equal elements ends in a sorted, non-empty array."""
    n = F.size(ordered)
    # ``sequence(1, 0)`` would count down, hence no empty arrays.
    return F.filter(
        F.sequence(F.lit(1), n),
        lambda i: (i == n) | (F.get(ordered, i - 1) != F.get(ordered, i)),
    )


def _run_start(ends: Column, k: Column) -> Column:
    return F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1))


def run_lengths(ordered: Column, name: str = "term") -> Column:
    """Elements of a sorted, non-empty array with their counts."""

    def entry(ends: Column):
        return lambda end, k: F.struct(
            F.get(ordered, end - 1).alias(name),
            (end - _run_start(ends, k)).cast("bigint").alias("tf"),
        )

    return let(_run_ends(ordered), lambda ends: F.transform(ends, entry(ends)))


def counted(values: Column, name: str = "term") -> Column:
    """Distinct elements of an array with their counts, as ``array<struct<name, tf>>``; null if empty.

    Sorting and run-length counting inside the row replaces a shuffle on (document, term).
    """
    return let(F.sort_array(values), lambda s: F.when(F.size(s) > 0, run_lengths(s, name)))
