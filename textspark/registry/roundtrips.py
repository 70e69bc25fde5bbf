"""Queries that write a format and read it back, and dictionary segmentation over whole documents."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.functions.text import tokenize, tokenize_raw
from textspark.operators.labels import label_index
from textspark.operators.optim import check_optimizer
from textspark.operators.segment import tokenize_dict
from textspark.operators.unnest import unnest_values
from textspark.registry import labels, sql
from textspark.session import materialise, work_dir
from textspark.sources import artefacts, csv, wordvec
from textspark.sources.tables import documents, table, utterances

MIN_FREQ = 30
LATIN = "abcdefghijklmnopqrstuvwxyz"
HAN_LETTERS = "".join(chr(0x4E00 + i) for i in range(len(LATIN)))


def _folder(spark) -> str:
    return f"{work_dir(spark)}/roundtrip-{uuid.uuid4().hex}"


def _csv_roundtrip(spark, sf) -> DataFrame:
    """Turns written as quoted CSV and scanned again, numbers as ``3.0`` among them."""
    path = _folder(spark)
    rows = table(spark, sf, "conversations").select(
        "conv_id", F.col("turn").cast("double").alias(" turn "), "role", F.col("text").alias("sentence_sep")
    )
    quoted = dict(header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rows.write.options(**quoted).csv(path)
    return csv.read_csv(spark, path, {"conv_id": "int", "turn": "int", "role": "string", "sentence_sep": "string"})


def _submission_file(spark, sf) -> DataFrame:
    path = csv.write_submission(utterances(spark, sf), f"{_folder(spark)}/deep/er")
    return spark.read.option("header", True).schema("ID string, c_numerical int").csv(path)


def _wordvec_scan(spark, sf) -> DataFrame:
    """Embeddings in thousandths as word-vector text, with a header and a broken line, scanned again."""
    path = _folder(spark)
    numbers = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("bigint").cast("string"))
    rows = table(spark, sf, "embeddings")
    dim = rows.select(F.size("embedding").alias("n")).first()["n"]
    lines = rows.select(F.concat_ws(" ", F.concat(F.lit("w"), "vec_id"), F.array_join(numbers, " ")).alias("value"))
    more = spark.createDataFrame([(f"9 {dim}",), ("broken " + "x " * dim,)], "value string")
    lines.union(more).write.text(path)
    found = wordvec.read_word_vectors(spark, path, dim)
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return found.select("term", F.size("vec").cast("bigint").alias("n"), total.cast("bigint").alias("total"))


def _artefact_roundtrip(spark, sf) -> DataFrame:
    """A label table and a configuration, saved, required, loaded and given their types."""
    path = _folder(spark)
    artefacts.save_table(label_index(documents(spark, sf)), f"{path}/labels")
    artefacts.save_json(spark, f"{path}/best_config", {"lr": "0.1", "batch_size": 8.0, "ngram_range": [1, 2]})
    artefacts.require(spark, f"{path}/labels", f"{path}/best_config")
    config = artefacts.load_best_config(spark, f"{path}/best_config")
    check_optimizer(config["optimizer"])
    assert not artefacts.exists(spark, f"{path}/none")
    return artefacts.load_table(spark, f"{path}/labels").select(
        "label_raw",
        "idx",
        F.lit(config["lr"]).alias("lr"),
        F.lit(config["batch_size"]).alias("batch_size"),
        F.lit(config["ngram_range"][1]).alias("ngram_hi"),
        F.lit(config["optimizer"]).alias("optimizer"),
    )


def _as_han(text: Column) -> Column:
    """Each Latin letter as a Han character: the corpus holds no Han text of its own."""
    return F.translate(F.lower(text), LATIN, HAN_LETTERS)


def _segmented(raw: bool):
    def query(spark, sf) -> DataFrame:
        docs = documents(spark, sf).select("doc_id", _as_han(F.col("sentence_sep")).alias("sentence_sep"))
        runs = F.regexp_extract_all("sentence_sep", F.lit(f"[{HAN_LETTERS}]+"), F.lit(0))
        freq = unnest_values(docs, [], runs, "term").groupBy("term").count()
        dictionary = materialise(freq.where(F.col("count") >= MIN_FREQ).select("term"))
        cut = tokenize_dict(docs, dictionary, raw=raw)
        joined = F.translate(F.array_join("tokens", "|"), HAN_LETTERS, LATIN)
        return cut.select("doc_id", F.size("tokens").cast("bigint").alias("n"), F.md5(joined).alias("digest"))

    return query


def _null_token(spark, sf) -> DataFrame:
    """All tokens, cleaned and as they are, of every text and of a missing text beside each, read as the word ``nan``."""
    docs = documents(spark, sf).select("doc_id", F.lit(False).alias("missing"), "sentence_sep")
    docs = docs.union(docs.select("doc_id", F.lit(True), F.lit(None).cast("string")))
    both = [tokenize("sentence_sep", remove_stopwords=False, null_token="nan"), tokenize_raw("sentence_sep", null_token="nan")]
    listed = docs.select("doc_id", "missing", *[t.alias(name) for t, name in zip(both, ("clean", "raw"))])
    digests = [F.md5(F.array_join(c, "|")).alias(f"{c}_digest") for c in ("clean", "raw")]
    sizes = [F.size(c).cast("bigint").alias(f"n_{c}") for c in ("clean", "raw")]
    return listed.select("doc_id", "missing", *sizes, *digests)


QUERIES = {
    "csv_roundtrip": _csv_roundtrip,
    "submission_file": _submission_file,
    "wordvec_scan": _wordvec_scan,
    "artefact_roundtrip": _artefact_roundtrip,
    "tokenize_dict": _segmented(False),
    "tokenize_raw_dict": _segmented(True),
    "null_token": _null_token,
}


def _cut(pattern: str) -> str:
    return f"""WITH RECURSIVE runs AS (
          SELECT doc_id, unnest(r) AS run, unnest(range(len(r))) AS pos
          FROM (SELECT doc_id, regexp_extract_all(lower(text), '{pattern}') AS r FROM documents)),
        freq AS (SELECT run AS term, count(*) AS n FROM runs WHERE regexp_full_match(run, '[a-z]+') GROUP BY run),
        dict AS (SELECT term FROM freq WHERE n >= {MIN_FREQ} AND length(term) > 1),
        longest AS (SELECT coalesce(max(length(term)), 0) AS most FROM dict),
        spans AS (SELECT run, i, CAST(unnest(range(2, least(most, length(run) - i + 1) + 1)) AS BIGINT) AS n
                  FROM longest, (SELECT term AS run, CAST(unnest(range(1, length(term) + 1)) AS BIGINT) AS i FROM freq)),
        best AS (SELECT run, i, max(n) AS n FROM spans JOIN dict ON dict.term = substr(run, i, n) GROUP BY run, i),
        walk(run, i, k, pieces) AS (
          SELECT term, CAST(1 AS BIGINT), CAST(0 AS BIGINT), '' FROM freq
          UNION ALL
          SELECT w.run, w.i + coalesce(b.n, 1), w.k + 1,
                 w.pieces || CASE WHEN w.k = 0 THEN '' ELSE '|' END || substr(w.run, w.i, coalesce(b.n, 1))
          FROM walk w LEFT JOIN best b ON b.run = w.run AND b.i = w.i WHERE w.i <= length(w.run)),
        cut AS (SELECT run, k, pieces FROM walk WHERE i > length(run))
        SELECT d.doc_id, CAST(coalesce(sum(coalesce(k, 1)) FILTER (r.run IS NOT NULL), 0) AS BIGINT) AS n,
               md5(coalesce(string_agg(coalesce(pieces, r.run), '|' ORDER BY pos), '')) AS digest
        FROM documents d LEFT JOIN runs r ON r.doc_id = d.doc_id LEFT JOIN cut c ON c.run = r.run GROUP BY d.doc_id"""


ORACLES = {
    "csv_roundtrip": """SELECT CAST(conv_id AS INTEGER) AS conv_id, CAST(turn AS INTEGER) AS turn, role,
        text AS sentence_sep FROM conversations""",
    "submission_file": """SELECT CAST(doc_id AS VARCHAR) AS "ID",
        CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS c_numerical FROM documents""",
    "wordvec_scan": """SELECT 'w' || vec_id AS term, CAST(len(embedding) AS BIGINT) AS n,
        CAST(list_sum([round(CAST(x AS DOUBLE) * 1000) FOR x IN embedding]) AS BIGINT) AS total
        FROM embeddings""",
    "artefact_roundtrip": f"""SELECT label_raw, idx, CAST(0.1 AS DOUBLE) AS lr, 8 AS batch_size, 2 AS ngram_hi,
        'adam' AS optimizer FROM ({labels.ORACLES['label_index']})""",
    "tokenize_dict": _cut("[a-z]+|[0-9]+"),
    "tokenize_raw_dict": _cut("[a-z]+|[0-9]+|[\\s\\S]"),
    "null_token": f"""SELECT doc_id, missing, CAST(len(c) AS BIGINT) AS n_clean, CAST(len(r) AS BIGINT) AS n_raw,
        md5(array_to_string(c, '|')) AS clean_digest, md5(array_to_string(r, '|')) AS raw_digest FROM (
        SELECT doc_id, missing, regexp_extract_all({sql.clean('t')}, '[a-zA-Z0-9]+|[一-龥]') AS c,
               regexp_extract_all(t, '[A-Za-z0-9]+|[\\s\\S]') AS r
        FROM (SELECT doc_id, false AS missing, coalesce(text, 'nan') AS t FROM documents
              UNION ALL SELECT doc_id, true, 'nan' FROM documents))""",
}
