"""Token counts by count-only Viterbi over a unigram vocabulary, whose scores can be fitted to the texts."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.llm.common import annotated, quoted, small_batches, without
from textspark.llm.wordhash import Tally, chunks

MARK = "▁"  # stands before every word
UNKNOWN_PENALTY = 10.0  # below the worst piece, as unigram tokenizers set it
CACHED_WORDS, CACHED_CHARS = 1 << 19, 40
CHUNK = 4 << 20
_NONE = -math.inf
_counters: dict[str, "PieceCounter"] = {}


def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _ordinary(model) -> list[int]:
    """Ids of a model without special pieces."""
    return [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, special pieces left out."""
    model = _model(path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in _ordinary(model)]


def fitted(docs: DataFrame, path: str) -> list[tuple[str, float]]:
    """The pieces of a file with unigram scores: logs of their shares in all texts as the file's model cuts them.

    The scores of a BPE file are ranks of merges, no log-probabilities. Every distinct word is cut once
    and counts as often as it stands in ``text``; each piece counts one more, so none has no score. The
    driver sees one sum for each piece of the file.
    """

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(["word", "n"])
        for batch in batches:
            for _, texts in chunks(pc.fill_null(batch.column(0), ""), CHUNK):
                yield from tally.add(*pc.value_counts(pc.ascii_split_whitespace(texts).flatten()).flatten())
        yield from tally.rows()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        sums = np.zeros(model.get_piece_size(), np.int64)
        for batch in batches:
            cut = model.encode(batch.column(0).to_pylist(), num_threads=1)
            times = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), [len(c) for c in cut])
            np.add.at(sums, np.array([i for c in cut for i in c], np.int64), times)
        found = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums[found])], names=["piece", "n"])

    texts = docs.select(quoted("text").cast("string").alias("text"))
    counts = texts.mapInArrow(words, "word string, n bigint").where("word != ''").groupBy("word").agg(F.sum("n").alias("n"))
    with small_batches(docs.sparkSession, 4000):
        rows = counts.mapInArrow(pieces, "piece bigint, n bigint").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    seen = {r["piece"]: r["n"] for r in rows}
    model = _model(path)
    ids = _ordinary(model)
    total = sum(seen.get(i, 0) + 1 for i in ids)
    return [(model.id_to_piece(i), math.log((seen.get(i, 0) + 1) / total)) for i in ids]


class PieceCounter(dict):
    """Number of pieces in the best segmentation of a word, with a bounded cache.

    An automaton lists all vocabulary matches in one pass, ordered by their end; for each end the best
    score and the pieces behind it are kept, nothing else. Of equal scores the one with the earliest
    start wins. Where no single character starts a piece, one unknown character does, ``UNKNOWN_PENALTY``
    below the worst piece; a run of unknown characters is one piece, or its bytes if all of them are pieces.
    """

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        super().__init__()
        self.scores: dict[str, float] = {}
        for piece, score in pieces:
            self.scores.setdefault(piece, score)
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.bytes = all(f"<0x{b:02X}>" in self.scores for b in range(256))

    def count(self, word: str) -> int:
        n = len(word)
        best, pieces = [0.0], [0]  # of the characters so far
        open_ = -1  # where a run of unknown characters ends that another one would join
        top, at, length = _NONE, 0, 0
        # Matches come by their end, those of one end by rising start; the last one closes what is left.
        for end, (size, score) in chain(self.automaton.iter(word) if self.scores else (), ((n, (0, 0.0)),)):
            while len(best) <= end:
                here = len(best) - 1
                unknown = length != 1 and best[here] + self.unknown > top
                if unknown:
                    top, at = best[here] + self.unknown, here
                    width = len(word[here].encode()) if self.bytes else 0 if open_ == here else 1
                    open_ = here + 1
                best.append(top)
                pieces.append(pieces[at] + (width if unknown else 1))
                top, length = _NONE, 0
            start = end + 1 - size
            length = size
            if size and best[start] + score > top:
                top, at = best[start] + score, start
        return pieces[n]

    def __missing__(self, word: str) -> int:
        got = self.count(MARK + word)
        if len(word) <= CACHED_CHARS:
            self[word] = got
        return got


def counter(key: str, pieces=None) -> PieceCounter:
    """One counter per worker process and vocabulary: a file, or a key and the broadcast pieces it names."""
    if key not in _counters:
        _counters[key] = PieceCounter(vocabulary(key) if pieces is None else pieces.value)
    return _counters[key]


def token_counts(docs: DataFrame, path: str, name: str = "n_tokens", pieces: list[tuple[str, float]] | None = None) -> DataFrame:
    """Columns of ``docs`` with the number of unigram tokens of each whole text.

    White space (ASCII) separates words and is dropped, each word is segmented with a mark before it, and
    the counts add up. A null or blank text has 0 tokens. A column named ``name`` is replaced; rows are
    neither dropped nor moved. ``pieces`` (see ``fitted``) are pieces and scores to use; without them each
    worker reads those of the file at ``path``.
    """
    key, shared = path, None
    if pieces is not None:
        key = hashlib.sha256(repr(pieces).encode()).hexdigest()
        shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def judge(texts: pa.Array) -> list[pa.Array]:
        counts = counter(key, shared)
        found = [np.zeros(0, np.int64)]
        for _, part in chunks(pc.fill_null(texts, ""), CHUNK):
            if len(counts) > CACHED_WORDS:
                counts.clear()
            words = pc.ascii_split_whitespace(part)
            coded = words.flatten().dictionary_encode()
            each = np.array([counts[w] if w else 0 for w in coded.dictionary.to_pylist()], np.int64)
            total = np.concatenate([[0], np.cumsum(each[coded.indices.to_numpy(zero_copy_only=False)])])
            at = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))])
            found.append(np.diff(total[at]))
        return [pa.array(np.concatenate(found))]

    return annotated(without(docs, name), "text", judge, f"`{name}` bigint")
