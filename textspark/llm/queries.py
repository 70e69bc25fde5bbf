"""The queries of the dealt operators, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textspark.llm import (
    ann,
    collocations,
    decontamination,
    jaccard,
    langid,
    mixing,
    packing,
    pii,
    quality,
    shards,
    spelling,
    tokens,
    urls,
)
from textspark.llm.common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "boundary"
    )


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judged(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), 24)
    return placed.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judged(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    return tokens.token_counts(docs, path, pieces=tokens.fitted(docs, path)).select("doc_id", "n_tokens")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.digest(base), 256).alias("base_sha256"), pii.digest(F.col("pii")).alias("spans"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    langs, model = langid.learned(docs.where(~held_out))
    found = langid.predicted(docs.select("doc_id", held_out.alias("held_out"), "text"), langs, model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("_row.doc_id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.contamination(docs, items, ["doc_id"])
    listed = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", listed, "contaminated")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_urls": op2_urls,
    "op3_neighbours": op3_neighbours,
    "op4_sharding": op4_sharding,
    "op5_quality": op5_quality,
    "op6_tokens": op6_tokens,
    "op7_pii": op7_pii,
    "op8_langid": op8_langid,
    "op9_jaccard": op9_jaccard,
    "op10_mixing": op10_mixing,
    "op11_decontamination": op11_decontamination,
    "op12_spelling": op12_spelling,
    "op13_collocations": op13_collocations,
}

# The other operators hold hashes, token ids, fits or random starts: tests/llm has their plain versions.
ORACLES: dict[str, str] = {
    "op9_jaccard": """WITH RECURSIVE words AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y
                   ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
                  WHERE 100 * c >= 75 * (x.n + y.n - c)),
        ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, w.b FROM reach r JOIN ways w ON w.a = r.b),
        least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM documents d JOIN least ON least.a = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id""",
    "op11_decontamination": """WITH d AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM benchmark),
        items AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ')
                  FOR i IN range(1, greatest(len(w) - 10, 0) + 2)]) AS gram FROM b WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT size FROM items),
        places AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM d, sizes WHERE len(w) >= size),
        hits AS (SELECT p.doc_id, p.i, p.size, items.item_id FROM (SELECT doc_id, i, size,
                 array_to_string(w[i:i + size - 1], ' ') AS gram FROM places) p JOIN items USING (size, gram)),
        covered AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM hits) GROUP BY doc_id),
        found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op13_collocations": """WITH texts AS (
          SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS pieces FROM documents),
        pieces AS (SELECT doc, lang, unnest(range(len(pieces))) AS piece, unnest(pieces) AS text FROM texts),
        lists AS (SELECT doc, lang, piece, regexp_extract_all(text, '[^\\x20\\x09]+') AS w FROM pieces),
        words AS (SELECT doc, lang, piece, unnest(range(len(w))) AS i, unnest(w) AS w1 FROM lists),
        totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
        runs AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4
                 FROM words WINDOW o AS (PARTITION BY doc, piece ORDER BY i)),
        f AS (SELECT lang, 1 AS size, w1 AS p, w1, '' AS w2, '' AS w3, '' AS w4, count(*)::HUGEINT AS f FROM runs GROUP BY ALL HAVING count(*) >= 30
              UNION ALL SELECT lang, 2, concat_ws(' ', w1, w2), w1, w2, '', '', count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
              UNION ALL SELECT lang, 3, concat_ws(' ', w1, w2, w3), w1, w2, w3, '', count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
              UNION ALL SELECT lang, 4, concat_ws(' ', w1, w2, w3, w4), w1, w2, w3, w4, count(*) FROM runs WHERE w4 IS NOT NULL
              GROUP BY ALL HAVING count(*) >= 30),
        parts AS (SELECT lang, p, f, 1 AS k, w1 AS p1, trim(concat_ws(' ', w2, w3, w4), ' ') AS p2 FROM f WHERE size > 1
              UNION ALL SELECT lang, p, f, 2, concat_ws(' ', w1, w2), trim(concat_ws(' ', w3, w4), ' ') FROM f WHERE size > 2
              UNION ALL SELECT lang, p, f, 3, concat_ws(' ', w1, w2, w3), w4 FROM f WHERE size > 3),
        cuts AS (SELECT c.lang, c.p, c.f AS a, k, x.f AS l, y.f AS r, (2000000 * c.f) // (x.f + y.f) AS score FROM parts c
                 JOIN f x ON x.lang = c.lang AND x.p = p1 JOIN f y ON y.lang = c.lang AND y.p = p2),
        scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
        above AS (SELECT lang, p, max(f) AS f FROM (
              SELECT lang, f, unnest([concat_ws(' ', w1, w2), concat_ws(' ', w2, w3)]) AS p FROM f WHERE size = 3
              UNION ALL SELECT lang, f, unnest([concat_ws(' ', w1, w2), concat_ws(' ', w2, w3), concat_ws(' ', w3, w4),
                     concat_ws(' ', w1, w2, w3), concat_ws(' ', w2, w3, w4)]) FROM f WHERE size = 4) GROUP BY lang, p),
        kept AS (SELECT s.* FROM scored s LEFT JOIN above u ON u.lang = s.lang AND u.p = s.p WHERE NOT coalesce(100 * u.f >= 80 * s.a, false))
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(p)) AS rank, p AS phrase, a::BIGINT AS a,
               l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
        FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000""",
}
