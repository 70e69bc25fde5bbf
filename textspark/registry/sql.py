"""Building blocks of the SQL that checks the registered queries."""

from __future__ import annotations

SPLIT = (
    "CASE WHEN {id} % 10 < 6 THEN 'train' WHEN {id} % 10 < 8 THEN 'dev' ELSE 'test' END"
)

DOCS = f"""docs AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS "ID", text AS sentence_sep, lang AS label_raw,
         {SPLIT.format(id='doc_id')} AS split
  FROM documents)"""

CODES = """codes AS (
  SELECT label_raw, row_number() OVER (ORDER BY label_raw) - 1 AS c_numerical
  FROM (SELECT DISTINCT lang AS label_raw FROM documents))"""


def clean(x: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(regexp_replace(coalesce({x}, ''), '\\[sep\\]', ' ', 'gi'), "
        f"'[^一-龥a-zA-Z0-9]', ' ', 'g'), '\\s+', ' ', 'g'))"
    )


def rounded(x: str) -> str:
    return f"round({x}, 6) + 0.0"


CLEANED = f"""cleaned AS (
  SELECT doc_id, split, label_raw, lower({clean('sentence_sep')}) AS txt FROM docs)"""

WORDS = """words AS (
  SELECT doc_id, split, pos, term FROM (
    SELECT doc_id, split, unnest(string_split(txt, ' ')) AS term,
           generate_subscripts(string_split(txt, ' '), 1) AS pos
    FROM cleaned)
  WHERE term <> '')"""

TEXT = f"WITH {DOCS}, {CLEANED}, {WORDS}"


def normal(key: str) -> str:
    """Standard normal from the md5 of a key, by Box-Muller."""

    def uniform(first: int) -> str:
        return f"(CAST(CAST('0x' || substr(md5({key}), {first}, 8) AS BIGINT) AS DOUBLE) + 1) / 4294967297.0"

    return f"sqrt(-2 * ln({uniform(1)})) * cos(2 * pi() * {uniform(9)})"


def word_grams(lo: int, hi: int, source: str = "words") -> str:
    """``(doc_id, split, term)`` for every word n-gram."""
    parts = []
    for n in range(lo, hi + 1):
        chain = "term" + "".join(
            f" || ' ' || lead(term, {i}) OVER (PARTITION BY doc_id ORDER BY pos)" for i in range(1, n)
        )
        parts.append(f"SELECT doc_id, split, {chain} AS term FROM {source}")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE term IS NOT NULL"


def char_wb_grams(lo: int, hi: int) -> str:
    """``(doc_id, split, term)`` for every n-gram within a padded word."""
    parts = [
        f"SELECT doc_id, split, substr(w, CAST(i AS BIGINT), {n}) AS term FROM ("
        f"SELECT doc_id, split, ' ' || term || ' ' AS w, "
        f"unnest(range(1, length(term) + 4 - {n})) AS i FROM words)"
        for n in range(lo, hi + 1)
    ]
    return " UNION ALL ".join(parts)


def char_grams(lo: int, hi: int) -> str:
    """``(doc_id, split, term)`` for every n-gram of the whole cleaned text."""
    chars = (
        "SELECT doc_id, split, unnest(string_split(txt, '')) AS c, "
        "generate_subscripts(string_split(txt, ''), 1) AS pos FROM cleaned WHERE txt <> ''"
    )
    parts = []
    for n in range(lo, hi + 1):
        chain = "c" + "".join(
            f" || lead(c, {i}) OVER (PARTITION BY doc_id ORDER BY pos)" for i in range(1, n)
        )
        parts.append(f"SELECT doc_id, split, {chain} AS term FROM ({chars})")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE term IS NOT NULL"


STATS = """SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df
  FROM (SELECT doc_id, term, count(*) AS tf FROM {grams} GROUP BY doc_id, term) GROUP BY term"""
