"""Small tables with the awkward cases every operator must bear, and plain versions of the contracts."""

import random
import re
from collections import Counter

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves, and one with a dot
        *(T.StructField(n, T.StringType()) for n in ("size", "shard", "_row", "_rid", "kind", "n", "quality", "a.b")),
    ]
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sentence(rng, n, vocabulary):
    out = []
    for i in range(n):
        w = rng.choice(vocabulary)
        out.append(w.capitalize() if i % 12 == 0 else w + "." if i % 12 == 11 else w)
    return " ".join(out)


def documents(spark, extra=()):
    """Nulls in every column, empty and long texts, copies, near copies, repeated rows and odd white space."""
    rng = random.Random(5)
    vocabulary = ["the", "of", "and", "to", "in"] * 12 + ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    texts = [sentence(rng, rng.randint(60, 200), vocabulary) for _ in range(40)]
    texts += [texts[0]] * 5 + [texts[1].replace(" of ", " off ", 1), texts[2] + " one more", texts[3].upper()]
    texts += [None, "", "   \n\t ", "one", "one two three", "x" * 5000, sentence(rng, 6000, vocabulary)]
    texts += ["\x0bwords\x0c with\r\nodd   blanks\x1c here ", "naïve Ünïcödé 日本語 words", texts[4] + "\n" + texts[4], *extra]
    rows = [
        (i, t, rng.choice(["en", "de", None]), ["a", "b", "c", None, "a", "a"][i % 6], None if t is None else len(t), *["x"] * 7, None)
        for i, t in enumerate(texts)
    ]
    rows += [rows[3], rows[3], (None, texts[5], None, None, None, *[None] * 8)]
    return spark.createDataFrame(rows, DOCS)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)


def measures(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = {x for x, n in Counter(windows).items() if n > 1}
    covered = {j for i, x in enumerate(windows) if x in often for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    found = []
    for place, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == "email"
                or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                or kind == "card" and 14 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 10 <= len(digits) <= 15
            ):
                found.append((m.start(), place, m.end(), kind))
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(found)]
