"""Words of whole Arrow batches as spans and 64-bit hashes, and filters of hashes with a bound on their size."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LONGEST = 1 << 16  # bytes of a word that the vectorised hash takes; longer ones are digested one by one
FILTER_BITS = 28  # at most 2^28 bits, 32 MB
SLICE_BITS = 15  # bits of one bitmap of Spark


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)  # a random number for each byte
_POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(LONGEST - 1, np.uint64(0xD6E8FEB86659FD93))]), dtype=np.uint64)


def chunks(texts: pa.Array, size: int) -> Iterator[tuple[int, pa.Array]]:
    """``texts`` in order with the row they begin at, about ``size`` bytes at a time; a longer text comes alone."""
    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(total, (total[low - 1] if low else 0) + size, "right"))
        high = min(max(high, low + 1), len(texts))
        yield low, texts.slice(low, high - low)
        low = high


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, A-Z lower-cased, and where each begins (one more than texts); null is empty."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return LOWER[data], at - at[0]


def spans(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of true bytes; none reaches over the bounds ``at`` of the texts."""
    before, after = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[at[at < len(inside)]] = False
    after[at[at > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


class Words:
    """The words of some texts: ``low`` their bytes end to end, ``size`` bytes of each, ``at`` the first word of each text."""

    def __init__(self, texts: pa.Array, word_bytes: np.ndarray) -> None:
        self.data, bounds = text_bytes(texts)
        inside = word_bytes[self.data]
        self.begin, end = spans(inside, bounds)
        self.size = end - self.begin
        self.at = np.searchsorted(self.begin, bounds)
        self.low = self.data[inside]

    @cached_property
    def hashes(self) -> np.ndarray:
        """A 64-bit hash of the bytes of each word."""
        if not len(self.size):
            return np.zeros(0, np.uint64)
        first = np.cumsum(self.size) - self.size
        place = np.arange(len(self.low)) - np.repeat(first, self.size)
        values = _BYTES[self.low] * _POWERS[np.minimum(place, LONGEST - 1)]
        found = _mixed(np.add.reduceat(values, first) + self.size.astype(np.uint64))
        for i in np.flatnonzero(self.size > LONGEST):
            word = self.low[first[i] : first[i] + self.size[i]].tobytes()
            found[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return found

    @cached_property
    def last(self) -> np.ndarray:
        """For each word, one past the last word of its text."""
        return np.repeat(self.at[1:], np.diff(self.at))

    @cached_property
    def _spaced(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with one space behind each, and where each begins (one more than words)."""
        begins = np.concatenate([[0], np.cumsum(self.size + 1)])
        data = np.full(begins[-1], 32, np.uint8)
        keep = np.ones(begins[-1], bool)
        keep[begins[1:] - 1] = False
        data[keep] = self.low
        return data, begins

    def phrases(self, first: np.ndarray, length: int) -> pa.Array:
        """The ``length`` words from each of ``first`` on, joined by spaces."""
        data, begins = self._spaced
        low, size = begins[first], begins[first + length] - 1 - begins[first]
        ends = np.cumsum(size)
        picked = data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - size), size)]
        bounds = np.concatenate([[0], ends]).astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(picked)])


def gram_hashes(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A hash for every ``length`` words in a row (none if there are fewer)."""
    n = max(len(words) - length + 1, 0)
    found = np.full(n, np.uint64(seed) + np.uint64(length))
    for k in range(length):
        found = _mixed((found + words[k : k + n]) * _STEP)
    return found


class Tally:
    """Counts of values by their keys, added up in a bounded table before they are handed on."""

    def __init__(self, names: list[str], most: int = 1 << 19) -> None:
        self.names, self.most = names, most
        self.held: list[pa.Table] = []
        self.size = 0

    def add(self, *columns: pa.Array) -> Iterator[pa.RecordBatch]:
        """Adds rows, the counts in the last column; yields sums when there are too many to hold."""
        self.held.append(pa.Table.from_arrays(list(columns), names=self.names))
        self.size += len(columns[0])
        if self.size > self.most:
            self._sum()
            if self.size > self.most // 2:
                yield from self.rows()

    def _sum(self) -> None:
        table = pa.concat_tables(self.held).group_by(self.names[:-1]).aggregate([(self.names[-1], "sum")])
        self.held, self.size = [table.rename_columns(self.names)], table.num_rows

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            self._sum()
            kinds = [pa.string()] * (len(self.names) - 1) + [pa.int64()]
            yield from self.held[0].cast(pa.schema(list(zip(self.names, kinds)))).to_batches(max_chunksize=1 << 16)
        self.held, self.size = [], 0


def signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


class HashFilter:
    """Which hashes may belong to a set: two bits each in a bitmap of at most 2^``FILTER_BITS`` bits.

    It never misses a member. With many members it lets more strangers through, so whoever asks it must
    check what passes; its size, which is what the driver and the workers hold, stays bounded.
    """

    def __init__(self, hashes: DataFrame, column: str = "h") -> None:
        spark = hashes.sparkSession
        self.members = hashes.count()
        self.bits = min(max((16 * self.members).bit_length(), SLICE_BITS), FILTER_BITS)
        h = F.col(column)
        ways = F.array(F.shiftrightunsigned(h, 64 - self.bits), h.bitwiseAND(F.lit((1 << self.bits) - 1)))
        bit = hashes.select(F.explode(ways).alias("bit"))
        piece = F.shiftright("bit", SLICE_BITS).alias("piece")
        maps = bit.groupBy(piece).agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit((1 << SLICE_BITS) - 1))).alias("map"))
        held = np.zeros(1 << (self.bits - 3), np.uint8)
        width = 1 << (SLICE_BITS - 3)
        for row in maps.toLocalIterator():
            held[row["piece"] * width : (row["piece"] + 1) * width] = np.frombuffer(row["map"], np.uint8)
        self.held = spark.sparkContext.broadcast(held.tobytes())

    def __getstate__(self) -> dict:
        return {"bits": self.bits, "held": self.held}

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        held = np.frombuffer(self.held.value, np.uint8)
        top = hashes >> np.uint64(64 - self.bits)
        found = (held[top >> np.uint64(3)] >> (top & np.uint64(7)).astype(np.uint8)) & 1 == 1
        some = np.flatnonzero(found)
        low = hashes[some] & np.uint64((1 << self.bits) - 1)
        found[some] = (held[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found
