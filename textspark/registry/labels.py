"""Queries over label dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from textspark.operators import labels as ops
from textspark.registry import sql
from textspark.sources.tables import documents, quality_utterances, split_of, table, utterances


def _parts(df):
    return df.where("split = 'train'"), df.where("split = 'dev'")


def _label_index(spark, sf):
    return ops.label_index(documents(spark, sf))


def _label_index_code(spark, sf):
    return ops.label_index_by_code(_parts(utterances(spark, sf))[0])


def _label_outer(spark, sf):
    return ops.label_codes(*_parts(utterances(spark, sf))).orderBy("c_numerical")


def _label_union(spark, sf):
    return ops.label_pairs(*_parts(utterances(spark, sf)))


def _by_source(spark, sf):
    """Documents labelled by their source: a label set in which splits differ."""
    return table(spark, sf, "documents").select(
        F.col("source").alias("label_raw"), split_of(F.col("doc_id")).alias("split")
    )


def _labels_missing(spark, sf):
    return ops.labels_missing(*_parts(_by_source(spark, sf)))


def _label_metadata(spark, sf):
    return ops.label_metadata(*_parts(utterances(spark, sf)))


def _label_encode(spark, sf):
    docs = documents(spark, sf)
    return ops.encode_labels(docs, ops.label_index(docs)).select("doc_id", "label_raw", "idx")


def _label_decode(spark, sf):
    coded = utterances(spark, sf).select("doc_id", F.col("c_numerical").cast("bigint").alias("idx"))
    return ops.decode_labels(coded, ops.label_index(documents(spark, sf)))


def _quality_labels(spark, sf):
    return ops.label_index_by_code(quality_utterances(spark, sf))


QUERIES = {
    "label_index": _label_index,
    "label_index_code": _label_index_code,
    "label_outer": _label_outer,
    "label_union": _label_union,
    "labels_missing": _labels_missing,
    "label_metadata": _label_metadata,
    "label_encode": _label_encode,
    "label_decode": _label_decode,
    "quality_labels": _quality_labels,
}

_BASE = f"""WITH {sql.DOCS}, {sql.CODES},
    u AS (SELECT d.*, CAST(c.c_numerical AS INTEGER) AS c_numerical FROM docs d JOIN codes c USING (label_raw)),
    train AS (SELECT DISTINCT label_raw, c_numerical FROM u WHERE split = 'train'),
    dev AS (SELECT DISTINCT label_raw, c_numerical FROM u WHERE split = 'dev')"""

ORACLES = {
    "label_index": f"WITH {sql.CODES} SELECT label_raw, c_numerical AS idx FROM codes",
    "label_index_code": f"""{_BASE} SELECT label_raw, c_numerical,
        row_number() OVER (ORDER BY c_numerical, label_raw) - 1 AS idx FROM train""",
    "label_outer": f"""{_BASE} SELECT label_raw, max(c_numerical) AS c_numerical
        FROM train FULL OUTER JOIN dev USING (label_raw, c_numerical) GROUP BY label_raw""",
    "label_union": f"{_BASE} SELECT * FROM train UNION SELECT * FROM dev",
    "labels_missing": f"""WITH s AS (SELECT source AS label_raw, {sql.SPLIT.format(id='doc_id')} AS split FROM documents)
        SELECT DISTINCT label_raw FROM s WHERE split = 'dev'
        AND label_raw NOT IN (SELECT label_raw FROM s WHERE split = 'train')""",
    "label_metadata": f"""{_BASE}, ranked AS (SELECT label_raw, c_numerical,
          row_number() OVER (ORDER BY c_numerical, label_raw) - 1 AS idx FROM train)
        SELECT label_raw, c_numerical, idx FROM (SELECT * FROM train UNION SELECT * FROM dev)
        LEFT JOIN ranked USING (label_raw, c_numerical)""",
    "label_encode": f"{_BASE} SELECT doc_id, label_raw, CAST(c_numerical AS BIGINT) AS idx FROM u",
    "label_decode": f"{_BASE} SELECT doc_id, CAST(c_numerical AS BIGINT) AS idx, label_raw FROM u",
    "quality_labels": """SELECT CAST(quality AS VARCHAR) AS label_raw, CAST(quality AS INTEGER) AS c_numerical,
          row_number() OVER (ORDER BY quality) - 1 AS idx
        FROM (SELECT DISTINCT quality FROM labels JOIN documents USING (doc_id))""",
}
