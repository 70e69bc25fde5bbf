"""Phrase collocations: Misra-Gries summaries find every frequent n-gram, a second pass counts those exactly.

Phrases grow word by word. A phrase is frequent only if its words less the first and less the last are,
so places where both are known to be frequent are summed up; the summaries of a hash partition are merged
with more counters than its mass divided by the threshold, so every frequent phrase keeps one. Then the
texts are read again and what kept a counter is counted by its words.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textspark.llm.common import quoted, small_batches
from textspark.llm.wordhash import HashFilter, Tally, Words, chunks, gram_hashes, signed
from textspark.operators.lookup import lookup
from textspark.session import materialise

THRESHOLD, LONGEST, SHARE, TOP, SCALE = 30, 4, 80, 2000, 2_000_000
CHUNK = 4 << 20
BATCH_ROWS = 2000
LOCAL = 1 << 22  # places that a task sums up together
PART_MASS = 1 << 26  # places of one hash partition, about; its summary has mass / threshold counters
BLOB = 1 << 14  # entries of one row of a summary
FOLDS = 64  # of a language, when the best of each are taken first

# Pieces end at . , ; : ! ? and at line ends; words at these, space and tab.
WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[9, 10, 11, 12, 13, 32, *b".,;:!?"]] = False
PIECE_BYTES = WORD_BYTES.copy()
PIECE_BYTES[[9, 32]] = True


class Pieces(Words):
    """Words of texts of one language; ``ends`` is one past the last word of each word's piece. N-grams hash by language."""

    def __init__(self, lang: str, texts: pa.Array) -> None:
        super().__init__(texts, WORD_BYTES)
        stops = np.cumsum(~PIECE_BYTES[self.data])[self.begin]
        new = np.diff(stops, prepend=-1) != 0
        new[self.at[:-1][self.at[:-1] < len(new)]] = True
        first = np.flatnonzero(new)
        size = np.diff(first, append=len(new))
        self.ends = np.repeat(first + size, size)
        self.seed = zlib.crc32(lang.encode())

    def grams(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether ``length`` words in a row stand in one piece, and their hashes, for each place with so many words from it on."""
        n = max(len(self.size) - length + 1, 0)
        return np.arange(n) + length <= self.ends[:n], gram_hashes(self.hashes, length, self.seed)


Work = Callable[[Iterator[tuple[str, Pieces]]], Iterator[pa.RecordBatch]]


def _by_language(docs: DataFrame, work: Work, schema: str, then: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Applies ``work`` to the texts of each partition, parsed one language and some megabytes at a time, and writes what ``then`` makes of it."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Pieces]]:
        for batch in batches:
            lang, text = batch.column(0), batch.column(1)
            for one in pc.unique(lang).to_pylist():
                for _, part in chunks(text.filter(pc.equal(lang, one)), CHUNK):
                    yield one, Pieces(one, part)

    chosen = docs.select(F.coalesce(quoted("lang").cast("string"), F.lit("und")), F.coalesce(quoted("text").cast("string"), F.lit("")))
    with small_batches(docs.sparkSession, BATCH_ROWS):
        return materialise(then(chosen.mapInArrow(lambda batches: work(pieces(batches)), schema)))


def _counted(docs: DataFrame, phrases: Callable[[Pieces], pa.Array], then: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``then`` makes of ``lang, phrase, f``: the exact counts of what ``phrases`` picks."""

    def work(pieces: Iterator[tuple[str, Pieces]]) -> Iterator[pa.RecordBatch]:
        tally = Tally(["lang", "phrase", "f"])
        for lang, p in pieces:
            phrase, f = pc.value_counts(phrases(p)).flatten()
            yield from tally.add(pa.array([lang] * len(f), pa.string()), phrase, f)
        yield from tally.rows()

    schema = "lang string, phrase string, f bigint"
    return _by_language(docs, work, schema, lambda df: then(df.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))))


def word_table(docs: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Frequent words ``lang, phrase, f, length``, and ``lang, n``: occurrences of all words."""
    words = _counted(docs, lambda p: p.phrases(np.arange(len(p.size)), 1), lambda df: df)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return words.where(F.col("f") >= threshold).withColumn("length", F.lit(1)), materialise(totals)


def hashed(frequent: DataFrame, length: int) -> DataFrame:
    """``h``: the hashes of frequent phrases of ``length`` words, as their places have them."""

    def work(pieces: Iterator[tuple[str, Pieces]]) -> Iterator[pa.RecordBatch]:
        for _, p in pieces:
            inside, grams = p.grams(length)
            yield pa.RecordBatch.from_arrays([signed(grams[inside])], names=["h"])

    return _by_language(frequent.select("lang", F.col("phrase").alias("text")), work, "h bigint")


def open_places(p: Pieces, length: int, shorter: HashFilter) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``length`` words in one piece whose words less the last and less the first pass, and their hashes."""
    inside, grams = p.grams(length)
    held = shorter.holds(p.grams(length - 1)[1])
    places = np.flatnonzero(inside & held[: len(inside)] & held[1 : len(inside) + 1])
    return places, grams[places]


def summaries(docs: DataFrame, length: int, shorter: HashFilter, parts: int, threshold: int) -> DataFrame:
    """``part, mass, hashes, counts``: local sums of the places of phrases, by hash partition.

    A local count stops at the threshold, which alone makes a phrase frequent: so the mass of a phrase is
    at most threshold times tasks, however often it stands in the texts.
    """

    def work(pieces: Iterator[tuple[str, Pieces]]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            # The hash spreads evenly; its top half, scaled, is the partition, so order by hash is order by partition.
            hashes, counts = np.unique(np.concatenate(held), return_counts=True)
            counts = np.minimum(counts, threshold)
            part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            cuts = np.flatnonzero(np.diff(part)) + 1
            bounds = [(at, min(at + BLOB, hi)) for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(part)]) for at in range(lo, hi, BLOB)]
            small = counts.astype("<u4" if threshold > 255 else "u1")
            for at in range(0, len(bounds), 64):
                some = bounds[at : at + 64]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(part[lo]) for lo, _ in some], pa.int64()),
                        pa.array([int(counts[lo:hi].sum()) for lo, hi in some], pa.int64()),
                        pa.array([hashes[lo:hi].tobytes() for lo, hi in some], pa.binary()),
                        pa.array([small[lo:hi].tobytes() for lo, hi in some], pa.binary()),
                    ],
                    names=["part", "mass", "hashes", "counts"],
                )

        for _, p in pieces:
            held.append(open_places(p, length, shorter)[1])
            size += len(held[-1])
            if size >= LOCAL:
                yield from rows()
                held, size = [], 0
        if size:
            yield from rows()

    return _by_language(docs, work, "part bigint, mass bigint, hashes binary, counts binary")


class MisraGries:
    """A mergeable summary with ``capacity`` counters: with more than mass / t of them, what occurs t times keeps one.

    ``taken`` is what counters have lost, so a count is at most its counter and ``taken`` together.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.taken = 0

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((hashes, counts))
        self.size += len(hashes)
        if self.size > max(self.capacity, 1 << 20):
            self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        hashes = np.concatenate([self.hashes, *(h for h, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]))
        self.hashes, self.counts = hashes[order][first], np.add.reduceat(counts[order], first)
        self.waiting, self.size = [], 0
        if len(self.counts) > self.capacity:
            # The next counter after the largest ``capacity`` is taken off all: each unit off costs a full round of mass.
            least = np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1]
            self.counts = self.counts - least
            self.taken += int(least)
            self.hashes, self.counts = self.hashes[self.counts > 0], self.counts[self.counts > 0]


def survivors(local: DataFrame, threshold: int) -> DataFrame:
    """``h``: hashes whose counter may stand for a frequent phrase once the summaries of their partition are merged."""
    mass = local.groupBy("part").agg(F.sum("mass").alias("total"))
    laid = lookup(local.select("part", "hashes", "counts"), materialise(mass), "part")
    laid = laid.repartition("part").sortWithinPartitions("part")
    kind = "<u4" if threshold > 255 else "u1"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, summary = None, None

        def kept() -> Iterator[pa.RecordBatch]:
            summary.merge()
            yield pa.RecordBatch.from_arrays([signed(summary.hashes[summary.counts + summary.taken >= threshold])], names=["h"])

        for batch in batches:
            for part, total, hashes, counts in zip(*(batch.column(k) for k in ("part", "total", "hashes", "counts"))):
                if at != part.as_py():
                    if summary is not None:
                        yield from kept()
                    at, summary = part.as_py(), MisraGries(total.as_py() // threshold + 1)
                summary.add(np.frombuffer(hashes.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), kind).astype(np.int64))
        if summary is not None:
            yield from kept()

    with small_batches(local.sparkSession, 64):
        return materialise(laid.select("part", "total", "hashes", "counts").mapInArrow(run, "h bigint"))


def exact(docs: DataFrame, length: int, shorter: HashFilter, kept: HashFilter, threshold: int) -> DataFrame:
    """Second pass: frequent phrases ``lang, phrase, f, length``, counted by their words where the summaries kept them."""

    def phrases(p: Pieces) -> pa.Array:
        places, grams = open_places(p, length, shorter)
        return p.phrases(places[kept.holds(grams)], length)

    return _counted(docs, phrases, lambda df: df.where(F.col("f") >= threshold).withColumn("length", F.lit(length)))


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, f, length`` of all phrases of 1 to ``longest`` words with ``threshold`` occurrences, and ``lang, n``."""
    spark = docs.sparkSession
    table, totals = word_table(docs, threshold)
    places = totals.agg(F.sum("n")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-places // PART_MASS))
    levels = [table]
    for length in range(2, longest + 1):
        shorter = HashFilter(hashed(levels[-1], length - 1))
        local = summaries(docs, length, shorter, parts, threshold)
        levels.append(exact(docs, length, shorter, HashFilter(survivors(local, threshold)), threshold))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out, totals


def _key(lang: str, phrase) -> Column:
    """One string for a language and a phrase; the length keeps them apart."""
    return F.concat(F.length(lang).cast("string"), F.lit(":"), F.col(lang), phrase)


def collocations(
    docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, share: int = SHARE, top: int = TOP, scale: int = SCALE
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language in ``docs`` (``text, lang``).

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and those into words at
    space and tab; counts are per ``lang`` (null: ``und``) and inside pieces, overlaps included. ``a`` is the
    count of a phrase of 2 to ``longest`` words, at least ``threshold``; cut in two, its parts count ``l`` and
    ``r``, and the lowest ``floor(scale * a / (l + r))`` over the cuts, the first of equal ones, is its score.
    A phrase inside a longer one that is ``share`` percent as frequent is dropped. ``n`` counts all words.
    Ranks go by score, ``a`` and phrase, in UTF-8 byte order.

    A null or empty text has no words, an empty table no phrases; repeated rows count each. Other columns
    are not read, whatever their names. Arithmetic is in decimals of 38 digits.
    """
    table, totals = frequent_phrases(docs, threshold, longest)
    table = materialise(table.withColumn("_key", _key("lang", F.col("phrase"))))
    candidates = table.where("length > 1").select("lang", "phrase", F.col("f").alias("a"), "length", "_key", F.split("phrase", " ").alias("w"))
    cuts = candidates.select("_key", "a", "w", "length", "lang", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    part = F.array(
        F.struct(F.lit(True).alias("left"), F.array_join(F.slice("w", 1, F.col("k")), " ").alias("words")),
        F.struct(F.lit(False).alias("left"), F.array_join(F.slice("w", F.col("k") + 1, F.col("length") - F.col("k")), " ").alias("words")),
    )
    asked = cuts.select(F.col("_key").alias("whole"), "a", "k", "lang", F.inline(part))
    asked = materialise(asked.select("whole", "a", "k", "left", _key("lang", F.col("words")).alias("_key")))
    users = asked.groupBy("_key").agg(F.count("*").alias("users"))
    known = materialise(table.select("_key", "f").join(users, "_key"))
    told = lookup(asked, known, "_key", "inner", weight="users")
    each = told.groupBy("whole", "k").agg(
        F.first("a").alias("a"), F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r")
    )
    both = F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)")
    score = F.expr(f"cast({scale} as decimal(17,0)) * cast(a as decimal(20,0))")
    each = each.select("whole", "k", "l", "r", score.alias("_up"), both.alias("_down")).withColumn("score", F.expr("_up div _down"))
    scored = each.groupBy(F.col("whole").alias("_key")).agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    # Each longer phrase names the phrases inside it; the most frequent one above a phrase decides.
    low = F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)
    inner = candidates.where("length > 2").select("lang", "a", "w", "length", F.explode(F.sequence(F.lit(2), F.col("length") - 1)).alias("size"))
    inner = inner.select("lang", "a", F.explode(F.transform(low, lambda i: F.array_join(F.slice("w", i, F.col("size")), " "))).alias("words"))
    above = inner.groupBy(_key("lang", F.col("words")).alias("_key")).agg(F.max("a").alias("above"))
    covered = F.col("above").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * share
    left = candidates.drop("w").join(above, "_key", "left").where(~F.coalesce(covered, F.lit(False)))
    found = materialise(left.join(scored, "_key").select("lang", "phrase", "a", "best.l", "best.r", "best.score"))

    # A language may hold most phrases: the best of each fold first, then of the language.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    fold = Window.partitionBy("lang", "_fold").orderBy(*order)
    first = found.withColumn("_fold", F.pmod(F.xxhash64("phrase"), F.lit(FOLDS))).withColumn("_at", F.row_number().over(fold)).where(F.col("_at") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return lookup(ranked, totals, "lang", "inner").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
