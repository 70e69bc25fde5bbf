"""Frequencies of n-grams over a corpus, counted by groups of texts as numbers in an alphabet."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUP_CHARS = 1 << 21  # characters of the texts that are counted together
_MOST = 1 << 62


def coded_points(texts: pa.Array) -> np.ndarray:
    """The code points of some texts end to end."""
    return np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)


def _letters(texts: pa.Array, words: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The alphabet of some texts (their words or characters), all letters end to end, and the text of each."""
    if words:
        lists = pc.split_pattern(texts, " ")
        flat = lists.flatten()
        owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        real = pc.not_equal(flat, "")
        coded = flat.filter(real).dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), owner[real.to_numpy(zero_copy_only=False)]
    owner = np.repeat(np.arange(len(texts)), pc.utf8_length(texts).to_numpy(zero_copy_only=False))
    read = coded_points(texts)
    seen = np.zeros(int(read.max(initial=0)) + 1, bool)
    seen[read] = True
    points, code = np.flatnonzero(seen), np.zeros(len(seen), np.int64)
    code[points] = np.arange(len(points))
    return pa.array([chr(p) for p in points], pa.string()), code[read], owner


def _starts(n: int, letter: np.ndarray, owner: np.ndarray, blank: int | None) -> np.ndarray:
    """Where n-grams begin: within one text and, given the code of the ``blank``, inside one padded word."""
    last = len(letter) - n + 1
    if last <= 0:
        return np.empty(0, np.int64)
    good = owner[:last] == owner[n - 1 :]
    if blank is not None and n > 1:
        is_blank = letter == blank
        if n == 2:
            good &= ~(is_blank[:-1] & is_blank[1:])
        else:
            seen = np.append(0, np.cumsum(is_blank))
            good &= seen[n - 1 : n - 1 + last] == seen[1 : 1 + last]
    return np.flatnonzero(good)


def _counted(texts: pa.Array, words: bool, inside: bool, lo: int, hi: int) -> Iterator[pa.RecordBatch]:
    """``term, tf, df`` of the n-grams of some texts; texts whose n-grams fit no 64 bits together are halved."""
    alphabet, letter, owner = _letters(texts, words)
    size, joint = len(alphabet), " " if words else ""
    bits = max(len(texts) - 1, 0).bit_length()  # the text of a key is its low bits
    if size**hi << bits >= _MOST and len(texts) > 1:
        half = len(texts) // 2
        yield from _counted(texts.slice(0, half), words, inside, lo, hi)
        yield from _counted(texts.slice(half), words, inside, lo, hi)
        return
    blank = pc.index(alphabet, " ").as_py() if inside and size else None
    blank = -1 if blank is not None and blank < 0 else blank
    for n in range(lo, hi + 1):
        at = _starts(n, letter, owner, blank)
        if not len(at):
            continue
        if size**n >= _MOST:  # one text of a huge alphabet: its n-grams are counted as tuples
            found = Counter(zip(*(letter[at + i].tolist() for i in range(n))))
            digits, tf = np.array(list(found), np.int64).T, np.array(list(found.values()), np.int64)
            df = np.ones(len(tf), np.int64)
        else:
            gram = letter[at]
            for i in range(1, n):
                gram = gram * size + letter[at + i]
            key = gram << bits
            key |= owner[at]
            key.sort()
            first = np.append(0, np.flatnonzero(key[1:] != key[:-1]) + 1)
            times = np.diff(first, append=len(key))
            gram = key[first] >> bits
            begin = np.append(0, np.flatnonzero(gram[1:] != gram[:-1]) + 1)
            tf, df = np.add.reduceat(times, begin), np.diff(begin, append=len(gram))
            rest, digits = gram[begin], []
            for _ in range(n):
                rest, digit = np.divmod(rest, max(size, 1))
                digits.insert(0, digit)
        parts = [alphabet.take(pa.array(d)) for d in digits]
        term = parts[0] if n == 1 else pc.binary_join_element_wise(*parts, joint)
        yield pa.RecordBatch.from_arrays([term, pa.array(tf, pa.int64()), pa.array(df, pa.int64())], names=["term", "tf", "df"])


def is_words(method: str) -> bool:
    return method in ("bow", "ngram", "tfidf")


def readable(method: str, text: str = "text") -> Column:
    """The blank-joined text as the n-grams of ``method`` are read from it end to end; null if there is nothing to read."""
    if method == "char_wb_tfidf":
        body = F.trim(text)
        return F.when(body != "", F.concat(F.lit(" "), F.regexp_replace(body, r"\s+", "  "), F.lit(" ")))
    return F.col(text) if is_words(method) else F.regexp_replace(text, r"\s\s+", " ")


def gram_stats(df: DataFrame, method: str, lo: int, hi: int, text: str = "text") -> DataFrame:
    """``(term, tf, df)``: ``term_stats`` over the n-grams that ``analyse`` finds in blank-joined texts.

    Each group of texts is counted where it is read, as sorted numbers, and sends each of its terms once.
    """
    words, inside = is_words(method), method == "char_wb_tfidf"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(0), "")
            ends, at = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
            while at < len(texts):
                to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GROUP_CHARS, "right")), at + 1)
                yield from _counted(texts.slice(at, to - at), words, inside, lo, hi)
                at = to

    parts = df.select(readable(method, text).alias("text")).mapInArrow(work, "term string, tf bigint, df bigint")
    return parts.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
