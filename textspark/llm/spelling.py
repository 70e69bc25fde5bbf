"""Spelling variants by dense prefix-suffix tiling: words that are one edit apart, and the form each belongs to.

Two words are one edit apart exactly if their common prefix and common suffix together reach the longer
length less one. The letters before and behind the edit are equal, so words are laid into tiles that agree
in a prefix and a suffix and leave ``FREE`` places between them for the edit; inside a tile all rows of a
padded code-point matrix are compared with each other. Words of a tile differ in at most ``FREE`` + 1
places in a row, which bounds every tile by the alphabet, whatever the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textspark.llm.common import quoted, small_batches
from textspark.llm.wordhash import Tally, chunks, spans, text_bytes
from textspark.operators.lookup import lookup
from textspark.session import materialise

EDITED = 31  # one of so many pairs of document and word loses a code point
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
FREE = 2  # places an edit can take inside a tile
BLOCK = 256  # rows of a block; a larger tile is compared as pairs of blocks, each a unit of its own
CELLS = 1 << 22  # code points compared at once
CHUNK = 4 << 20
BATCH_ROWS = 2000
# Code points U+00C0 to U+00FF are the byte C3 and one more; letters of a word fit one byte in Latin-1.
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = True


def edited(runs: pa.Array, keys: list[bytes], run_of: np.ndarray) -> pa.Array:
    """``runs`` without the code point that the crc32 of ``<doc_id>:<run>`` picks, where it is divisible by ``EDITED``."""
    prefix = [zlib.crc32(k + b":") for k in keys]
    words = runs.cast(pa.large_binary()).to_pylist()
    sums = np.fromiter(map(zlib.crc32, words, map(prefix.__getitem__, run_of.tolist())), np.int64, len(words))
    picked = np.flatnonzero(sums % EDITED == 0)
    if not len(picked):
        return runs
    new = []
    for i in picked.tolist():
        word = words[i].decode()
        at = int(sums[i]) % len(word)
        new.append(word[:at] + word[at + 1 :])
    mask = np.zeros(len(words), bool)
    mask[picked] = True
    return pc.replace_with_mask(runs, pa.array(mask), pa.array(new, runs.type))


def _runs(ids: list, texts: pa.Array, least: int) -> pa.Array:
    """Words of ``least`` code points and more of some texts, as they count."""
    data, at = text_bytes(texts)
    lead = data == 0xC3
    inside = LETTERS[data] | lead
    inside[1:] |= lead[:-1]
    begin, end = spans(inside, at)
    code_points = np.concatenate([[0], np.cumsum(inside & ~lead)])
    # An edit takes one code point off, so shorter runs yield no word.
    keep = code_points[end] - code_points[begin] >= least
    begin, size = begin[keep], (end - begin)[keep]
    ends = np.cumsum(size)
    picked = data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)]
    bounds = np.concatenate([[0], ends]).astype(np.int64)
    runs = pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(picked)])
    keys = [("" if i is None else str(i)).encode() for i in ids]
    words = edited(runs, keys, np.searchsorted(at, begin, "right") - 1)
    return words.filter(pc.greater_equal(pc.utf8_length(words), least))


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: words of ``least_length`` code points and more with ``least_count`` occurrences or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(["word", "n"])
        for batch in batches:
            for low, texts in chunks(batch.column(1).fill_null(""), CHUNK):
                ids = batch.column(0).slice(low, len(texts)).to_pylist()
                yield from tally.add(*pc.value_counts(_runs(ids, texts, least_length)).flatten())
        yield from tally.rows()

    chosen = docs.select(quoted("doc_id").cast("string"), quoted("text").cast("string"))
    with small_batches(docs.sparkSession, BATCH_ROWS):
        counted = chosen.mapInArrow(run, "word string, n bigint")
        return materialise(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def tiled(words: DataFrame) -> DataFrame:
    """Each word once for every tile it lies in: ``size, part, head, word, n``.

    ``size`` is the length of the longer word of a pair, so a word takes part with its own length and as
    the shorter one. An edit at places ``FREE * part`` to ``FREE * (part + 1)`` keeps the letters before
    the first and behind the last of them, whose hash is ``head``.
    """
    size = F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("size")
    each = words.select("word", "n", size)
    parts = F.sequence(F.lit(0), F.greatest(F.floor((F.col("size") - 2) / FREE), F.lit(0)).cast("int"))
    each = each.select("*", F.explode(parts).alias("part"))
    low = (F.col("part") * FREE).cast("int")
    behind = F.greatest(F.col("size") - 1 - low - FREE, F.lit(0)).cast("int")
    length = F.length("word")
    head = F.xxhash64(F.substr("word", F.lit(1), low), F.substr("word", length - behind + 1, behind))
    return each.select("size", "part", head.alias("head"), "word", "n")


def units(tiles: DataFrame) -> DataFrame:
    """``size, part, head, one, two, side, word, n``: tiles, and of large ones pairs of blocks that are compared with each other."""
    key = ["size", "part", "head"]
    tiles = materialise(tiles)
    large = tiles.groupBy(*key).count().where(F.col("count") > BLOCK)
    large = materialise(large.select(F.struct(*key).alias("_key"), F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"), "count"))
    laid = lookup(tiles.select(F.struct(*key).alias("_key"), "word", "n"), large, "_key", weight="count")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    laid = laid.select("_key.*", "word", "n", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    return laid.select(
        *key, F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), (F.col("own") > F.col("other")).alias("side"), "word", "n"
    )


def _compare(size: int, part: int, words: np.ndarray, lengths: np.ndarray, side: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which rows of each tile are one edit apart: tiles × rows × rows, from Latin-1 bytes padded with zeros.

    Of a pair the longer word has ``size`` letters. A pair lies in several tiles if the edit can be placed
    in several ways; the one with its first place counts it.
    """
    rows = np.arange(size)
    behind = np.where(rows < lengths[..., None], np.take_along_axis(words, np.maximum(lengths[..., None] - 1 - rows, 0), -1), 0)
    same, last = (x[:, :, None, :] == x[:, None, :, :] for x in (words, behind))
    shorter = np.minimum(lengths[:, :, None], lengths[:, None, :])
    prefix = np.minimum(np.logical_and.accumulate(same, -1).sum(-1), shorter)
    suffix = np.minimum(np.logical_and.accumulate(last, -1).sum(-1), shorter)
    first = size - 1 - np.minimum(suffix, size - 1)
    low = part * FREE
    near = (prefix >= first) & (first >= low) & ((first < low + FREE) | (low + FREE >= size - 1))
    near &= (lengths[:, :, None] == size) | (lengths[:, None, :] == size)
    near &= (shorter >= size - 1) & ~((prefix == size) & (suffix == size))
    # Of two blocks rows of one side meet those of the other; rows that only pad a tile meet none.
    near &= own[:, None, None] | (side[:, :, None] != side[:, None, :])
    return near


def _near(table: pa.Table) -> pa.RecordBatch | None:
    """Of whole units: how many near words each word has there, and the most frequent of them."""
    size, part = (table[c].to_numpy() for c in ("size", "part"))
    head, one, two = (table[c].to_numpy() for c in ("head", "one", "two"))
    start = np.flatnonzero(np.concatenate([[True], (np.diff(size) != 0) | (np.diff(part) != 0) | (np.diff(head) != 0) | (np.diff(one) != 0) | (np.diff(two) != 0)]))
    count = np.diff(np.append(start, table.num_rows))
    start, count = start[count > 1], count[count > 1]
    if not len(start):
        return None
    letters = [w.encode("latin-1") for w in table["word"].to_pylist()]
    length = np.fromiter(map(len, letters), np.int64, len(letters))
    side = table["side"].to_numpy(zero_copy_only=False)
    times = table["n"].to_numpy()
    found: list[tuple[np.ndarray, ...]] = []
    padded = 1 << np.ceil(np.log2(count)).astype(np.int64)  # tiles of about one size stand in one matrix
    kinds, of_kind = np.unique(np.stack([size[start], part[start], padded]), axis=1, return_inverse=True)
    members = np.split(np.argsort(of_kind.ravel(), kind="stable"), np.cumsum(np.bincount(of_kind.ravel()))[:-1])
    for (wide, place, rows), mine in zip(kinds.T.tolist(), members):
        step = max(1, CELLS // (rows * rows * wide))
        for at in range(0, len(mine), step):
            some = mine[at : at + step]
            real = np.arange(rows) < count[some][:, None]
            index = np.where(real, start[some][:, None] + np.arange(rows), start[some][:, None])
            matrix = np.frombuffer(b"".join(letters[i].ljust(wide, b"\0") for i in index.ravel().tolist()), np.uint8).reshape(*index.shape, wide)
            own = one[start[some]] == two[start[some]]
            near = _compare(wide, place, matrix, np.where(real, length[index], -9), side[index], own)
            n_near = near.sum(-1)
            i, j = np.nonzero(n_near)
            if len(i):
                # Rows of a unit come by falling count, then by word, so the first near one is the best.
                best = index[i, near[i, j].argmax(-1)]
                found.append((index[i, j], n_near[i, j], best))
    if not found:
        return None
    word, n_near, best = (np.concatenate(x) for x in zip(*found))
    names = table["word"].combine_chunks()
    return pa.RecordBatch.from_arrays(
        [names.take(pa.array(word)), pa.array(n_near), pa.array(times[best]), names.take(pa.array(best))], names=["word", "n_near", "best_n", "best"]
    )


def _whole_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Applies ``_near`` to as many whole units of a sorted partition as are at hand."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new])
        keys = np.stack([held[c].to_numpy() for c in ("size", "part", "head", "one", "two")])
        open_ = int(np.flatnonzero((keys != keys[:, -1:]).any(0))[-1]) + 1 if (keys != keys[:, -1:]).any() else 0
        if open_:
            got = _near(held.slice(0, open_))
            if got is not None:
                yield got
            held = held.slice(open_)
    if held is not None:
        got = _near(held)
        if got is not None:
            yield got


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best``: words of ``word, n`` that have near ones, how many, and the most frequent of them.

    Of equally frequent ones the first in code-point order. Links are added up where they are found; no pair is a row.
    """
    key = ["size", "part", "head", "one", "two"]
    laid = units(tiled(words)).repartition(*key).sortWithinPartitions(*key, F.desc("n"), "word")
    schema = T.StructType.fromDDL("word string, n_near bigint, best_n bigint, best string")
    found = laid.select(*key, "side", "word", "n").mapInArrow(_whole_units, schema)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best")).select(
        "word", "n_near", (-F.col("_best.n")).alias("best_n"), F.col("_best.best").alias("best")
    )


def rooted(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: the form's form and so on. Counts grow along the way, so it ends."""
    roots = materialise(forms.select("word", F.col("form").alias("root")))
    steps = forms.select(F.col("word").alias("root"), F.col("form").alias("_next"))
    while True:
        users = roots.groupBy("root").agg(F.count("*").alias("_users"))
        dim = materialise(steps.join(users, "root"))
        if dim.isEmpty():
            return roots
        roots = materialise(lookup(roots, dim, "root", weight="_users").select("word", F.coalesce("_next", "root").alias("root")))


def variants(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the words of ``docs`` (``doc_id, text``).

    Words are runs of ASCII letters and U+00C0 to U+00FF, A-Z lower-cased, less the code point that the
    crc32 of ``<doc_id>:<run>`` picks if ``EDITED`` divides it; those of ``least_length`` code points and
    ``least_count`` occurrences count. Words are near if one code point inserted, deleted or replaced makes
    one the other. A word's ``form`` is its most frequent near word (ties: first in code-point order), if
    that is ``times`` as frequent, else null; ``root`` the last of the forms reached, the word itself if none.

    A null text has no words, an empty table none at all; a null ``doc_id`` reads as empty. Repeated rows
    count each. Other columns are not read, whatever their names.
    """
    words = word_counts(docs, least_length, least_count)
    near = materialise(near_words(words))
    joined = words.join(near, "word", "left")
    far = F.col("best_n") >= times * F.col("n")
    joined = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(far, F.col("best")).alias("form"), F.when(far, F.col("best_n")).alias("form_n"),
    )
    joined = materialise(joined)
    roots = rooted(joined.where("form is not null").select("word", "form"))
    out = joined.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
