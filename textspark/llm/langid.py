"""Language ID by multilingual mixture inference over character n-grams.

A document is a mixture of languages; expectation-maximisation over its n-grams estimates the
proportions, and the set of languages is the one with the best penalised likelihood.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.llm.common import annotated, without

SIZES = (1, 2, 3)
BITS = 15  # buckets of n-grams; bounds the model at 2^15 numbers a language
SMOOTHING = 0.5
FLOOR = 0.02  # share of each n-gram's probability that all languages share, so one odd n-gram decides little
ROUNDS = 12
PENALTY = 1.0  # weight of the logarithm of the text's length, for each further language
BATCH_CHARS = 1 << 20
UNDETERMINED = "und"
_MIX = np.uint32(0x9E3779B1)


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts end to end, lower-cased, other runs than letters as one blank; and each end."""
    clean = pc.replace_substring_regex(pc.utf8_lower(texts), "[^\\pL]+", " ")
    padded = pc.binary_join_element_wise("", pc.utf8_trim(clean, " "), "", " ")
    ends = np.cumsum(pc.utf8_length(padded).to_numpy(zero_copy_only=False).astype(np.int64))
    joined = "".join(padded.to_pylist())
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32), ends


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text, bucket, count`` of the n-grams in all texts, by text and bucket.

    An n-gram is a run of letters and single blanks between words; each text stands between blanks.
    """
    codes, ends = _codes(texts)
    owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    lettered = np.bincount(owner, codes != 32, len(ends)) > 0
    keys = []
    with np.errstate(over="ignore"):
        mixed = np.zeros(len(codes), np.uint32)
        for k in range(max(SIZES)):
            n = len(codes) - k
            if n <= 0:
                break
            mixed = (mixed[:n] * np.uint32(31) + codes[k:]) * _MIX
            mixed ^= mixed >> np.uint32(15)
            if k + 1 in SIZES:
                inside = (owner[:n] == owner[k:]) & lettered[owner[:n]]  # none reaches over the end of a text
                if k == 0:
                    inside &= codes[:n] != 32
                bucket = (mixed >> np.uint32(32 - BITS)).astype(np.int64)
                keys.append(((owner[:n] << BITS) | bucket)[inside])
    key, count = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
    return key >> BITS, key & ((1 << BITS) - 1), count


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``BATCH_CHARS`` bytes of text each."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(size, (size[low - 1] if low else 0) + BATCH_CHARS, "right"))
        high = min(max(high, low + 1), len(texts))
        yield low, high
        low = high


def counted(docs: DataFrame) -> DataFrame:
    """``lang, bucket, n`` over all rows with text and language: summed in each task, then by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = batch.column(1)
            for low, high in _slices(texts):
                text, bucket, n = ngrams(texts.slice(low, high - low))
                of = langs[low:high][text]
                for lang in set(of.tolist()):
                    mine = of == lang
                    if lang not in sums:
                        sums[lang] = np.zeros(1 << BITS)
                    sums[lang] += np.bincount(bucket[mine], n[mine], 1 << BITS)
            if len(sums) > 256:  # bounded memory, whatever the number of languages
                yield from emit(sums)
                sums = {}
        yield from emit(sums)

    def emit(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "bucket", "n"]
            )

    sums = docs.where("lang is not null and text is not null").select("lang", "text").mapInArrow(run, "lang string, bucket int, n double")
    return sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def learned(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and log P(n-gram | language), one column each.

    The model has at most 2^BITS numbers a language, whatever the corpus: it may pass the driver.
    """
    table = counted(docs).toArrow()
    langs = sorted(set(table["lang"].to_pylist()))
    place = {x: i for i, x in enumerate(langs)}
    sums = np.zeros((1 << BITS, max(len(langs), 1)))
    at = np.fromiter((place[x] for x in table["lang"].to_pylist()), np.int64, len(table))
    sums[table["bucket"].to_numpy(), at] = table["n"].to_numpy()
    share = (sums + SMOOTHING) / (sums + SMOOTHING).sum(0)
    return langs, np.log((1 - FLOOR) * share + FLOOR * share.mean(1, keepdims=True))


def _fitted(chance: np.ndarray, count: np.ndarray, owner: np.ndarray, starts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each text by EM over its allowed languages; entries are sorted by text."""
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(ROUNDS):
        joint = chance * share[owner]
        joint *= (count / joint.sum(1))[:, None]
        share = np.add.reduceat(joint, starts, axis=0)
        share /= share.sum(1, keepdims=True)
    return share, np.add.reduceat(count * np.log((chance * share[owner]).sum(1)), starts)


def mixture(text: np.ndarray, bucket: np.ndarray, count: np.ndarray, texts: int, model: np.ndarray) -> np.ndarray:
    """Proportions of the languages in each text.

    EM over all languages gives the best likelihood any set can reach. Where it doesn't pay for a second
    language (``PENALTY`` times the logarithm of the length), the best single language stands; for the
    other texts the sets of the two, three and more largest proportions are fitted and compared, as long as
    a set of that size could still pay at that best likelihood.
    """
    langs = model.shape[1]
    out = np.zeros((texts, langs))
    if not len(text):
        return out
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    rows, owner = text[starts], np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(text))))
    logs = model[bucket]
    chance = np.exp(logs)
    share, fit = _fitted(chance, count, owner, starts, np.ones((len(rows), langs)))
    single = np.add.reduceat(count[:, None] * logs, starts, axis=0)
    cost = PENALTY * np.log(np.maximum(np.add.reduceat(count, starts), 2))
    best_share = np.zeros((len(rows), langs))
    best_share[np.arange(len(rows)), single.argmax(1)] = 1.0  # ties to the first language
    best = single.max(1) - cost
    open_ = np.flatnonzero(fit - 2 * cost > best)
    if len(open_):
        place = np.full(len(rows), -1)
        place[open_] = np.arange(len(open_))
        mine = place[owner] >= 0
        chance, count, owner = chance[mine], count[mine], place[owner[mine]]
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        order = np.argsort(-share[open_], axis=1, kind="stable")
        top, kept, most = best[open_], best_share[open_], fit[open_]
        for size in range(2, langs + 1):
            hopes = most - size * cost[open_] > top
            if not hopes.any():
                break
            mine = hopes[owner]
            some = owner[mine]
            first = np.flatnonzero(np.diff(some, prepend=-1))
            allowed = np.zeros((int(hopes.sum()), langs))
            np.put_along_axis(allowed, order[hopes][:, :size], 1.0, 1)
            numbered = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(some))))
            found, fits = _fitted(chance[mine], count[mine], numbered, first, allowed)
            value = fits - size * cost[open_][hopes]
            better = value > top[hopes]
            at = np.flatnonzero(hopes)[better]
            top[at], kept[at] = value[better], found[better]
        best_share[open_] = kept
    out[rows] = best_share
    return out


def predicted(docs: DataFrame, langs: list[str], model: np.ndarray, mixed: bool = False) -> DataFrame:
    """Columns of ``docs`` with ``lang_pred`` and ``score``, the proportion of that language.

    Only the text is read. A text that is null or has no letter is ``und`` with score 0, and so is
    every text if nothing was learned. Ties go to the first language by code point. ``mixed`` adds
    ``languages``, the selected set with its proportions. Columns with these names are replaced.
    """
    docs = without(docs, "lang_pred", "score", "languages")
    shared = docs.sparkSession.sparkContext.broadcast((langs, model))

    def judge(texts: pa.Array) -> list[pa.Array]:
        names, chance = shared.value
        pred, score, sets = [], [], []
        for low, high in _slices(texts):
            part = pc.fill_null(texts.slice(low, high - low), "")
            text, bucket, count = ngrams(part)
            share = mixture(text, bucket, count, high - low, chance) if names else np.zeros((high - low, 1))
            top = share.argmax(1)
            for row, at in zip(share, top.tolist()):
                found = row[at] > 0
                pred.append(names[at] if found else UNDETERMINED)
                score.append(float(min(row[at], 1.0)))
                if mixed:
                    sets.append([(names[i], float(row[i])) for i in np.flatnonzero(row > 0)] if found else [])
        more = [pa.array(sets, pa.map_(pa.string(), pa.float64()))] if mixed else []
        return [pa.array(pred, pa.string()), pa.array(score, pa.float64()), *more]

    added = "lang_pred string, score double" + (", languages map<string,double>" if mixed else "")
    return annotated(docs, "text", judge, added)
