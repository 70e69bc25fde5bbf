"""Benchmark decontamination by winnowing: shared fingerprints are joined, then extended to whole windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.llm.common import annotated, quoted, small_batches, without
from textspark.llm.wordhash import HashFilter, Words, chunks, gram_hashes, signed
from textspark.operators.lookup import lookup
from textspark.session import materialise

WINDOW = 10  # words of a window
GRAM = 5  # words of a fingerprint; the least of the WINDOW - GRAM + 1 grams of a window stands for it
CHUNK = 4 << 20
BATCH_ROWS = 2000
# Bytes of words: digits, small letters, and all bytes of characters beyond ASCII.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[0x30:0x3A] = WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x80:] = True

FINGERPRINT = "size int, print bigint, whole bigint, words string"
JOINED = ["size", "print", "whole", "words"]


def windows(words: Words, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of the windows of ``size`` words inside one text, their fingerprints, and hashes of them whole.

    The fingerprint is the least hash of the ``gram`` words in a row inside the window: equal windows have
    equal ones wherever they stand, and windows that follow each other mostly share theirs.
    """
    gram = min(gram, size)
    least = grams = gram_hashes(words.hashes, gram)
    n = max(len(words.hashes) - size + 1, 0)
    for k in range(1, size - gram + 1):
        least = np.minimum(least[:n], grams[k : k + n])
    first = np.flatnonzero(np.arange(n) + size <= words.last[:n])
    return first, least[first] + np.uint64(size), gram_hashes(words.hashes, size, 1)[first]


def _listed(size: int, prints: np.ndarray, wholes: np.ndarray, texts: pa.Array) -> list[pa.Array]:
    return [pa.array(np.full(len(prints), size, np.int32)), signed(prints), signed(wholes), texts.cast(pa.string())]


def item_windows(items: DataFrame, window: int, gram: int) -> DataFrame:
    """``item`` (the id as a string) and its windows; an item of fewer words is one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, texts in chunks(batch.column(1).fill_null(""), CHUNK // 8):
                words = Words(texts, WORD_BYTES)
                count = np.diff(words.at)
                for size in range(1, window + 1):
                    fits = count >= size if size == window else count == size
                    first, prints, wholes = windows(words, size, gram) if fits.any() else [np.zeros(0, np.int64)] * 3
                    text = np.searchsorted(words.at, first, "right") - 1
                    mine = fits[text] if len(first) else np.zeros(0, bool)
                    if mine.any():
                        listed = _listed(size, prints[mine], wholes[mine], words.phrases(first[mine], size))
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(low + text[mine])), *listed], names=["item", *JOINED])

    chosen = items.select(F.coalesce(quoted("item_id").cast("string"), F.lit("")).alias("item"), quoted("text").cast("string"))
    with small_batches(items.sparkSession, BATCH_ROWS):
        return materialise(chosen.mapInArrow(run, f"item string, {FINGERPRINT}").distinct())


def candidates(docs: DataFrame, sizes: list[int], gram: int, prints: HashFilter, wholes: HashFilter) -> DataFrame:
    """``docs`` with ``_n_words`` and ``_met``: windows whose fingerprint, and then whose whole hash, an item may hold."""

    def judge(texts: pa.Array) -> list[pa.Array]:
        counts, met = [], []
        for _, part in chunks(texts.fill_null(""), CHUNK):
            words = Words(part, WORD_BYTES)
            counts.append(np.diff(words.at))
            owner, columns = [], []
            for size in sizes:
                first, least, whole = windows(words, size, gram)
                near = np.flatnonzero(prints.holds(least))
                near = near[wholes.holds(whole[near])]
                first = first[near]
                text = np.searchsorted(words.at, first, "right") - 1
                owner.append(text)
                start = pa.array((first - words.at[text]).astype(np.int32))
                columns.append([start, *_listed(size, least[near], whole[near], words.phrases(first, size))])
            owner = np.concatenate([np.zeros(0, np.int64), *owner])
            order = np.argsort(owner, kind="stable")
            bounds = np.searchsorted(owner[order], np.arange(len(part) + 1)).astype(np.int32)
            if columns:
                flat = [pa.concat_arrays([c[k] for c in columns]).take(pa.array(order)) for k in range(5)]
            else:
                flat = [pa.array([], t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string())]
            met.append(pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(flat, names=["start", *JOINED])))
        if not met:
            kind = pa.struct(list(zip(["start", *JOINED], [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()])))
            return [pa.array([], pa.int64()), pa.array([], pa.list_(kind))]
        return [pa.array(np.concatenate(counts).astype(np.int64)), pa.concat_arrays(met)]

    return annotated(docs, "text", judge, f"_n_words bigint, _met array<struct<start int, {FINGERPRINT}>>")


def contamination(
    docs: DataFrame, items: DataFrame, keep: list[str] | None = None, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """``keep`` (all columns) of ``docs`` and ``n_words, n_hit, n_items, items, contaminated``: what ``docs`` share with ``items``.

    Words are runs of ASCII letters and digits, lower-cased, and of characters beyond ASCII. ``window`` words
    in a row of an item (``item_id, text``), or a whole item of fewer, are a window; ``n_hit`` counts the
    document's words inside any occurrence of one, ``items`` lists the ids of those items as strings in
    order. Every shared span of ``window`` words has a fingerprint in common, so none is missed.

    Fingerprints of the items are a filter of bounded size; windows of documents that pass it are joined to
    the items' by fingerprint, then by the whole window, words included. So rows are as many as true
    windows, however often a fingerprint repeats on either side. Documents that met the same windows share
    one list of items.

    A null or empty text has no words, hits or items; an item without words has no window. Rows of items
    with one id are one item, a null id is the empty string. Repeated rows of documents are judged each.
    Without items nothing is hit. Columns of ``docs`` named like an added one are replaced, others may have any name.
    """
    spark = docs.sparkSession
    keep = [c for c in without(docs, "n_words", "n_hit", "n_items", "items", "contaminated").columns if keep is None or c in keep]
    known = item_windows(items, window, gram)
    sizes = sorted(r["size"] for r in known.select("size").distinct().collect())  # at most ``window`` of them
    one = materialise(known.select(*JOINED).distinct().withColumn("win", F.monotonically_increasing_id()))
    links = lookup(known.withColumn("_key", F.struct(*JOINED)), one.select(F.struct(*JOINED).alias("_key"), "win"), "_key").select("win", "item")
    links = materialise(links)
    prints = HashFilter(one.select(F.col("print").alias("h")).distinct())
    wholes = HashFilter(one.select(F.col("whole").alias("h")).distinct())

    row = F.struct(*[quoted(c) for c in keep])
    packed = docs.select(row.alias("_kept"), quoted("text").cast("string").alias("text"))
    with small_batches(spark, BATCH_ROWS):
        found = candidates(packed, sizes, gram, prints, wholes).select("_kept", "_n_words", "_met")
        found = materialise(found.withColumn("_rid", F.monotonically_increasing_id()))
    met = found.where(F.size("_met") > 0).select("_rid", F.inline("_met"))
    times = met.groupBy(*JOINED).agg(F.count("*").alias("times"))
    times = materialise(one.join(times, JOINED))
    dim = times.select(F.struct(*JOINED).alias("_key"), "win", "times")
    hits = lookup(met.select("_rid", "start", F.struct(*JOINED).alias("_key")), dim, "_key", "inner", weight="times")
    hits = hits.select("_rid", "start", F.col("_key.size").alias("size"), "win")

    # Within one document windows come by their start, so the words a window adds are those behind the end so far.
    begin = F.struct(F.lit(0).cast("int").alias("to"), F.lit(0).cast("long").alias("n"))

    def add(sofar, hit):
        to = F.greatest(sofar["to"], hit["start"] + hit["size"])
        return F.struct(to.alias("to"), (sofar["n"] + to - F.greatest(sofar["to"], hit["start"])).cast("long").alias("n"))

    spans = F.array_sort(F.collect_list(F.struct("start", "size")))
    of_doc = hits.groupBy("_rid").agg(
        F.aggregate(spans, begin, add)["n"].alias("n_hit"), F.array_sort(F.collect_set("win")).alias("wins")
    )
    of_doc = materialise(of_doc)
    groups = materialise(of_doc.groupBy("wins").agg(F.count("*").alias("docs")).withColumn("_group", F.monotonically_increasing_id()))
    each = groups.select("_group", F.explode("wins").alias("win")).join(links, "win").select("_group", "item").distinct()
    lists = each.groupBy("_group").agg(F.array_sort(F.collect_list("item")).alias("items"))
    lists = materialise(groups.join(lists, "_group").select("wins", "items", "docs"))
    judged = lookup(of_doc, lists, "wins", weight="docs").select("_rid", "n_hit", "items")
    out = lookup(found.select("_rid", "_kept", "_n_words"), judged, "_rid")
    none = F.array().cast("array<string>")
    return out.select(
        "_kept.*",
        F.col("_n_words").alias("n_words"),
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
