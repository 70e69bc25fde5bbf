"""Look up the elements of arrays in a dimension, and put what is found back in their places.

Documents are taken in chunks of a bounded number of elements. A chunk sends a distinct element once with all its
places, so what moves follows the distinct elements of chunks, not those of documents or their rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.operators.lookup import BROADCAST_BYTES, lookup
from textspark.session import materialise

CHUNK = 1 << 19  # elements of one chunk; a longer document is one by itself


def pieces(batch: pa.RecordBatch, most: int) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
    """Keys, lists and their lengths, of at most ``most`` elements at a time."""
    sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")), at + 1)
        yield batch.column(0).slice(at, to - at), batch.column(1).slice(at, to - at), sizes[at:to]
        at = to


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every chunk a row for each document, and one for each distinct element."""
    names, ints = ["chunk", "key", "size", "place", "element", "at"], pa.int32()
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        for keys, lists, sizes in pieces(batch, CHUNK):
            flat, n = lists.flatten(), len(keys)
            head = [keys, pa.array(sizes, ints), pa.array(range(n), ints), pa.nulls(n, flat.type), pa.ListArray.from_arrays(pa.array([0] * (n + 1), ints), pa.array([], ints))]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, number)), *head], names=names)
            coded = flat.dictionary_encode(null_encoding="encode")
            line = (coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) << 32) | np.arange(len(flat))
            line.sort()
            code, place = line >> 32, line & ((1 << 32) - 1)
            first = np.flatnonzero(np.diff(code, prepend=-1))
            gaps = np.diff(place, prepend=0)
            gaps[first] = place[first]
            at = pa.ListArray.from_arrays(pa.array(np.append(first, len(line)), ints), pa.array(gaps, ints))
            n = len(first)
            none = [pa.nulls(n, keys.type), pa.nulls(n, ints), pa.nulls(n, ints)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, number)), *none, coded.dictionary, at], names=names)
            number += 1


def chunked(df: DataFrame, values: Column | str, key: str = "doc_id") -> DataFrame:
    """``chunk, key, size, place, element, at``, written. Rows of documents have a ``size``, the others an ``element``.

    ``at`` holds the gaps between the places of an element; it is never null, for Spark's writer to Python goes
    through all the null arrays before a row again.
    """
    rows = df.select(key, (F.col(values) if isinstance(values, str) else values).alias("values"))
    kind, element = rows.schema[key].dataType.simpleString(), rows.schema["values"].dataType.elementType.simpleString()
    return materialise(rows.mapInArrow(_chunks, f"chunk bigint, key {kind}, size int, place int, element {element}, at array<int>"))


def places(rows: pa.Table) -> tuple[pa.Array, np.ndarray, pa.Table, np.ndarray]:
    """Of one chunk the keys and sizes of its documents, the rows of its elements, and the number of its row at each place."""
    is_head = pc.is_valid(rows["size"])
    heads, own = rows.filter(is_head).sort_by("place"), rows.filter(pc.invert(is_head))
    gaps = own["at"].combine_chunks()
    size = pc.list_value_length(gaps).to_numpy(zero_copy_only=False).astype(np.int64)
    steps = gaps.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    total, first = np.cumsum(steps), np.cumsum(size) - size
    row = np.empty(len(steps), np.int64)
    row[total - np.repeat(total[first] - steps[first], size)] = np.repeat(np.arange(len(size)), size)
    return heads["key"].combine_chunks(), heads["size"].combine_chunks().to_numpy(zero_copy_only=False), own, row


def found(chunks: DataFrame, dim: DataFrame, on: str, weight: str | None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``chunked`` with the columns of ``dim``, null where there is none; the rows of documents stay."""
    heads, elements = chunks.where("size is not null"), chunks.where("size is null")
    met = lookup(elements.withColumnRenamed("element", on), dim, on, "left", weight, limit)
    return met.unionByName(heads.withColumnRenamed("element", on), allowMissingColumns=True)


def lookup_elements(
    df: DataFrame, values: Column | str, dim: DataFrame, on: str, value: Column, name: str, key: str = "doc_id", weight: str | None = None, limit: int = BROADCAST_BYTES,
    chunks: DataFrame | None = None,
) -> DataFrame:
    """``(key, name)``: per document ``value``, over ``dim`` and its key ``on``, for each element in its place.

    Documents without elements have an empty array. Rows of one key are one document: their elements are merged by
    place, then by value. ``chunks`` are those of ``values``, if they are there already.
    """
    kind = df.schema[key].dataType.simpleString()
    chunks = chunked(df, values, key) if chunks is None else chunks
    rows = found(chunks, dim, on, weight, limit).select("chunk", "key", "size", "place", "at", value.alias("value"))

    def put(rows: pa.Table) -> pa.Table:
        keys, sizes, own, row = places(rows)
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), own["value"].combine_chunks().take(pa.array(row)))
        return pa.table({key: keys, name: lists})

    out = rows.groupBy("chunk").applyInArrow(put, f"`{key}` {kind}, `{name}` array<{rows.schema['value'].dataType.simpleString()}>")
    twice = chunks.where("size is not null").select(F.col("key").alias("_key")).groupBy("_key").count().where("count > 1")
    if twice.isEmpty():
        return out
    out = materialise(out)
    same = F.col(key).eqNullSafe(F.col("_key"))
    placed = out.join(twice, same, "left_semi").select(key, F.posexplode_outer(name).alias("pos", "v"))
    one = F.when(F.col("pos").isNotNull(), F.struct("pos", "v"))
    merged = placed.groupBy(key).agg(F.array_sort(F.collect_list(one))["v"].alias(name))
    return out.join(twice, same, "left_anti").unionByName(merged)
