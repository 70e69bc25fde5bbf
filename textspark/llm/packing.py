"""Packing by concatenate and cut: prefix sums over partition totals give every token its place."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textspark.llm.common import small_batches
from textspark.session import materialise

SEQUENCE = 4096
END = 2  # the id that closes a document
CACHED_WORDS = 1 << 17
CACHED_CHARS = 40
BATCH = "8m"  # of texts that travel to a worker together; a longer text is a batch of its own
CHUNK = 2 << 20  # bytes of text encoded together; a longer text is a chunk of its own
# Letters and digits that the normaliser (composition, then lower case) turns into one letter or digit each. Others,
# as U+0130 or U+0958, can become a letter and a mark, which would be a piece with the full stop behind it.
PLAIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f\u03b1-\u03c9\u0410-\u044f"
SIGNS = "!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"  # of ASCII, without those around a special token
TAILED = f"(?s)^(?P<stem>.*[0-9{PLAIN}])(?P<tail>[{re.escape(SIGNS)}]+)$"
_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Ids of whole texts from the ids of their distinct words.

    The tokenizer drops white space, and neither its normaliser nor its pieces reach across it, so a
    text's ids are those of its words. Signs behind a plain letter or digit are a piece of their own, and
    letter case is dropped, so both are taken off before words are told apart. A bounded cache keeps the
    ids of short stems, as little-endian unsigned 32-bit bytes; of too many, those that most chunks had stay.
    """

    def __init__(self, path: str, most: int = CACHED_WORDS) -> None:
        self.most = most
        self.rows: dict[str, int] = {}  # in order of rows
        self.kept = pa.array([], pa.large_binary())  # ids by row
        self.uses = np.zeros(0, np.int64)  # chunks that had the word, lately
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # How the tokenizer spells single bytes: printable ones as themselves, the others as characters from U+0100 on.
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        others = [b for b in range(256) if b not in plain]
        spelling = {b: 256 + i for i, b in enumerate(others)}
        letters = [c for c in map(chr, range(0x450)) if re.fullmatch(f"[{PLAIN}]", c)]
        self.spelt = {c: c.lower().encode().decode("latin-1").translate(spelling) for c in letters}

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def learn(self, words: list[str]) -> pa.Array:
        """Ids of short words, as bytes. Those of plain letters are one piece, so the model cuts them without the normaliser's bookkeeping."""
        cut, spelt = self.tokenizer.model.tokenize, self.spelt.__getitem__
        found, odd = [], []
        for i, word in enumerate(words):
            try:
                found.append([k.id for k in cut(word if word.isascii() and word.isalpha() else "".join(map(spelt, word)))])
            except KeyError:
                found.append([])
                odd.append(i)
        for i, got in zip(odd, self.tokenizer.encode_batch_fast([words[i] for i in odd], add_special_tokens=False)):
            found[i] = got.ids
        at = np.cumsum([0, *map(len, found)], dtype=np.int64)
        ids = np.fromiter(chain.from_iterable(found), "<u4", at[-1])
        return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(at * 4), pa.py_buffer(ids)])

    def table(self, words: pa.Array) -> pa.Array:
        """The ids of some different words, as bytes."""
        known = words.to_numpy(zero_copy_only=False).tolist()
        rows = np.fromiter(map(self.rows.get, known, repeat(-1)), np.int64, len(known))
        new = np.flatnonzero(rows < 0)
        is_long = np.array([len(known[i]) > CACHED_CHARS for i in new], bool)
        short, long = new[~is_long], new[is_long]
        names, old = [known[i] for i in short], len(self.kept)
        self.kept = pa.concat_arrays([self.kept, self.learn(names)])
        self.rows.update(zip(names, range(old, len(self.kept))))
        rows[short] = np.arange(old, len(self.kept))
        self.uses = np.concatenate([self.uses, np.zeros(len(short), np.int64)])
        self.uses[rows[rows >= 0]] += 1
        rows[long] = np.arange(len(self.kept), len(self.kept) + len(long))
        beside = pa.array([self.ids(known[i]).tobytes() for i in long], pa.large_binary())
        return pa.concat_arrays([self.kept, beside]).take(pa.array(rows))

    def forget(self) -> None:
        """Halves the cache, and the uses of what stays, so that words of earlier texts can go."""
        stay = np.sort(np.argsort(-self.uses, kind="stable")[: self.most // 2])
        names = list(self.rows)
        self.rows = {names[i]: row for row, i in enumerate(stay)}
        self.kept, self.uses = self.kept.take(pa.array(stay)), self.uses[stay] // 2

    def encode(self, texts: pa.Array, close: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each closed by ``close``, and where each begins (one more than texts)."""
        if len(self.rows) > self.most:
            self.forget()
        words = pc.ascii_split_whitespace(texts)
        coded = pc.ascii_lower(words.flatten()).dictionary_encode()
        known = coded.dictionary
        ended = pc.is_in(pc.utf8_slice_codeunits(known, -1), value_set=pa.array(list(SIGNS)))
        parts = pc.extract_regex(known.filter(ended), TAILED)
        split = pc.is_valid(parts)
        where = np.zeros(len(known), bool)
        where[np.flatnonzero(ended)[split.to_numpy(zero_copy_only=False)]] = True
        where, parts = pa.array(where), parts.filter(split)
        stems = pc.replace_with_mask(known, where, pc.struct_field(parts, "stem")).dictionary_encode()
        tails = pc.replace_with_mask(pa.nulls(len(known), known.type).fill_null(""), where, pc.struct_field(parts, "tail")).dictionary_encode()
        halves = [self.table(x.dictionary).take(x.indices) for x in (stems, tails)]
        ids = pc.binary_join_element_wise(*halves, pa.scalar(b"", pa.large_binary()))
        # One more word closes a text; taking the words' ids in order lays them end to end.
        ids = pa.concat_arrays([ids, pa.array([np.array([close], "<u4").tobytes()], pa.large_binary())])
        at = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False), dtype=np.int64)])
        stream = np.insert(coded.indices.to_numpy(zero_copy_only=False), at[1:], len(known))
        line = ids.take(pa.array(stream))
        ends = np.frombuffer(line.buffers()[1], np.int64)[: len(stream) + 1] // 4
        return np.frombuffer(line.buffers()[2], "<u4")[: ends[-1]], ends[at + np.arange(len(at))]


def encoder(path: str, most: int) -> WordEncoder:
    """One encoder per worker process and vocabulary file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the threads
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    _encoders[path].most = most
    return _encoders[path]


def encoded(
    batches: Iterator[pa.RecordBatch], encode: Callable[[pa.Array, int], tuple[np.ndarray, np.ndarray]], part: int, end: int, chunk: int
) -> Iterator[pa.RecordBatch]:
    """Rows of ``tokenised`` from batches of ``doc_id, text`` of one partition, chunk by chunk."""
    total, pool = 0, pa.default_memory_pool()
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        chars = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(chars, (chars[low - 1] if low else 0) + chunk, "right"))
            high = min(max(high, low + 1), batch.num_rows)
            ids, at = encode(texts.slice(low, high - low), end)
            pool.release_unused()  # else each worker keeps several times what a chunk takes
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    pa.array(np.full(high - low, part, np.int32)),
                    pa.array(total + at[:-1]),
                    pa.array(np.diff(at)),
                    pa.Array.from_buffers(pa.large_binary(), high - low, [None, pa.py_buffer(at * 4), pa.py_buffer(ids)]).cast(pa.binary()),
                ],
                ["doc_id", "part", "before", "doc_tokens", "ids"],
            )
            total += int(at[-1])
            low = high


def tokenised(
    docs: DataFrame, vocabulary: str, end: int = END, cached: int = CACHED_WORDS, chunk: int = CHUNK
) -> DataFrame:
    """First pass: ``doc_id, ids`` with the place of the document in its partition.

    ``part`` is the partition, ``before`` the ids of the rows before this one in it. The result is
    written, so both passes see the same partitions even when tasks run again.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoded(batches, encoder(vocabulary, cached).encode, TaskContext.get().partitionId(), end, chunk)

    schema = f"doc_id {kind}, part int, before bigint, doc_tokens bigint, ids binary"
    with small_batches(docs.sparkSession, 4000, BATCH):
        return materialise(docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema))


def pack(
    docs: DataFrame,
    vocabulary: str,
    length: int = SEQUENCE,
    end: int = END,
    cached: int = CACHED_WORDS,
    chunk: int = CHUNK,
) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens:
    ``doc_id, start, length, ids, doc_tokens, sequence_id, offset, boundary``.

    All documents stand end to end, partition by partition; windows of fixed length cut the line, so
    only the last sequence is short. The first pass writes ids with running totals inside each
    partition, the sums of the partitions give its shift, and the second pass cuts each document where
    a window ends. ``boundary`` marks pieces in a window that reaches over the end of a partition.
    Concatenating the ``ids`` of a row's pieces by ``start`` gives the document back.

    A null or empty text is the end id alone. Repeated rows are packed each. An empty table gives no
    pieces; further columns are not carried. Which documents share a sequence follows the partitions of
    the input, as the order of documents has no meaning here. ``cached`` words and ``chunk`` bytes of text
    at a time bound a worker's memory; they change no result.
    """
    first = tokenised(docs, vocabulary, end, cached, chunk)
    # One row per partition of the first pass, whatever the data: safe to sort in one task and to broadcast.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        first.groupBy("part")
        .agg(F.sum("doc_tokens").alias("_sum"))
        .withColumn("_shift", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    )
    line = first.join(F.broadcast(parts), "part").withColumn("_at", F.col("_shift") + F.col("before"))
    window = F.explode(
        F.sequence(
            F.floor(F.col("_at") / length).cast("long"),
            F.floor((F.col("_at") + F.col("doc_tokens") - 1) / length).cast("long"),
        )
    )
    cut = line.withColumn("sequence_id", window)
    low = F.col("sequence_id") * length
    start = F.greatest(F.lit(0), low - F.col("_at"))
    size = F.least(F.col("doc_tokens"), low + length - F.col("_at")) - start
    return cut.select(
        "doc_id",
        start.alias("start"),
        size.alias("length"),
        F.substring("ids", (start * 4 + 1).cast("int"), (size * 4).cast("int")).alias("ids"),
        "doc_tokens",
        "sequence_id",
        (F.col("_at") + start - low).alias("offset"),
        ((low < F.col("_shift")) | (low + length > F.col("_shift") + F.col("_sum"))).alias("boundary"),
    )
