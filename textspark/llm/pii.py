"""Personal data: generators propose spans, boosted trees judge them, calibrated thresholds select."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textspark.llm.common import quoted, without
from textspark.operators.lookup import lookup
from textspark.session import materialise

BASE = ["email", "ip", "card", "phone"]
PROPOSED = ["secret", "number", "address"]
CONTEXT = 24  # characters kept on either side of a candidate
TREES, TREE_DEPTH = 15, 3
PRECISION = 0.95  # of the candidates above the threshold, on the calibration fold
BINS = 100
FOLD_ROWS = 20  # labelled proposals of a kind in the calibration fold from which on it has a threshold of its own

# Each pattern finds the same matches as its contract's, left to right. Possessive repeats where nothing
# follows that could want a character back, and starts only where a run starts (or the last match ended):
# so a long run costs one pass, and none of the repeats nests a call per character.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": f"(?:\\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
    "secret": "(?<![A-Za-z0-9_/+=-])[A-Za-z0-9_/+=-]{20,}+",
    "number": "(?<![0-9])[0-9](?:[\\x20().-]{0,2}[0-9]){8,}+",
    "address": "(?i)[A-Z0-9._-]{1,64}+ ?[\\[(] ?at ?[\\])] ?[A-Z0-9-]{1,64}(?: ?[\\[(.] ?(?:dot ?)?[\\])]? ?[A-Z0-9-]{2,24}){1,4}",
}
# Cheap tests that hold wherever the pattern can match.
GATES = {"email": "@", "phone": "+", "address": ("(at", "[at", "( at", "[ at")}
# Words to the left that tell what a number is, with nothing but short signs and words between; no other digits.
_NAMED = "(?<![a-z])(?:phone|call|tel|telephone|fax|mobile|cell|contact|iban|account|acct|ssn|passport|social security)(?:[a-z ]{0,12}[a-z])?[.:#= (]*\\z"
_OTHER = "(?<![a-z])(?:order|version|build|release|invoice|isbn|sku|serial|revision|timestamp|date|time)(?:[a-z ]{0,12}[a-z])?[.:#= (v]*\\z"
_DATED = "\\A(?:19|20)[0-9]{2}[-. ]?(?:0[1-9]|1[0-2])[-. ]?(?:0[1-9]|[12][0-9]|3[01])(?![0-9])"
_DOMAIN = "(?i)[\\[(.\\]) ](?:dot)?[\\]) ]* ?(?:com|org|net|edu|gov|info|io|co|eu|uk|de|fr|es|us)\\z"
# What a long string of letters and digits names when it is no secret, as the word before it.
_HASHED = "(?<![a-z])(?:commit|sha-?[0-9]{0,3}|md5|checksum|digest|etag|uuid|guid|hash|revision|build(?: id)?|blob|tree|fingerprint)[a-z_ ]{0,4}[\"']?[.:#= (]*[\"']?\\z|[a-z0-9._-]/\\z"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _possible(kind: str, text: Column) -> Column:
    gate = GATES.get(kind)
    if gate is None:
        return F.regexp_like(text, F.lit(PATTERNS[kind]))
    if isinstance(gate, str):
        return F.contains(text, F.lit(gate))
    low = F.lower(text)
    return F.contains(low, F.lit(gate[0])) | F.contains(low, F.lit(gate[1])) | F.contains(low, F.lit(gate[2])) | F.contains(low, F.lit(gate[3]))


def proposals(docs: DataFrame, kinds: list[str]) -> DataFrame:
    """``_rid, kind, start, end, match, left, right`` for every match of every kind in ``_rid, text``.

    The gaps between matches come from a split by the same pattern, their running lengths from a
    window per text and kind, so many matches in one text cost no more than one each.
    """
    finds = []
    for kind in kinds:
        pattern = F.lit(PATTERNS[kind])
        gaps = F.split("text", PATTERNS[kind], -1)
        found = F.zip_with(
            gaps,
            F.regexp_extract_all("text", pattern, F.lit(0)),
            lambda g, m: F.struct(F.length(g).alias("gap"), F.right(g, F.lit(CONTEXT)).alias("left"), m.alias("match"), F.left(g, F.lit(CONTEXT)).alias("head")),
        )
        found = F.when(_possible(kind, F.col("text")), found)
        finds.append(F.struct(F.lit(kind).alias("kind"), found.alias("found")))
    rows = (
        docs.select("_rid", F.inline(F.array(*finds)))
        .where("found is not null")
        .select("_rid", "kind", F.posexplode("found").alias("pos", "f"))
        .select("_rid", "kind", "pos", "f.*")
    )
    line = Window.partitionBy("_rid", "kind").orderBy("pos")
    ends = F.sum(F.col("gap") + F.coalesce(F.length("match"), F.lit(0))).over(line.rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.withColumn("end", ends.cast("int"))
        .withColumn("right", F.coalesce(F.lead("head").over(line), F.lit("")))
        .where("match is not null")
        .select("_rid", "kind", (F.col("end") - F.length("match")).alias("start"), "end", "match", "left", "right")
    )


def luhn(digits: Column) -> Column:
    """Whether 14 to 19 digits pass the check; false for any other number of digits."""
    at = F.sequence(F.lit(1), F.length(digits))
    value = lambda i: F.substring(digits, -i, F.lit(1)).cast("int")  # noqa: E731  from the right
    twice = lambda i: F.when(i % 2 == 0, value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0)).otherwise(value(i))
    total = F.aggregate(F.transform(at, twice), F.lit(0), lambda a, x: a + x)
    return F.when(F.length(digits).between(14, 19), total % 10 == 0).otherwise(F.lit(False))


def valid() -> Column:
    """Whether a match of a base kind stands, by the rules of its kind."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    return (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", F.regexp_like("match", F.lit(f"\\A{_OCTET}(?:\\.{_OCTET}){{3}}\\z")))
        .when(F.col("kind") == "card", luhn(digits))
        .when(F.col("kind") == "phone", F.length(digits).between(10, 15))
        .otherwise(False)
    )


def features() -> dict[str, Column]:
    """Format of a match and its surroundings; no check digits and no kind, which the labels rest on."""
    m, left, right = F.col("match"), F.lower("left"), F.col("right")
    count = lambda pattern: F.regexp_count(m, F.lit(pattern)).cast("double")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    n = F.greatest(F.length(m), F.lit(1)).cast("double")
    return {
        "chars": F.least(n, F.lit(200.0)),
        "digits": F.least(count("[0-9]"), F.lit(100.0)),
        "digit_share": count("[0-9]") / n,
        "upper_share": count("[A-Z]") / n,
        "hex": flag(F.regexp_like(m, F.lit("\\A(?=.*[0-9])(?=.*[a-f])[0-9a-f]+\\z"))),
        "dots": F.least(count("\\."), F.lit(10.0)),
        "groups": F.least(count("[A-Za-z0-9]+"), F.lit(20.0)),
        "signs": F.least(count("[-_/+=()]"), F.lit(20.0)),
        "at": flag(m.contains("@")),
        "spelled_at": flag(F.regexp_like(m, F.lit("(?i)[\\[(] ?at ?[\\])]"))),
        "plus": flag(m.startswith("+")),
        "turns": F.least(count("[0-9][A-Za-z]|[A-Za-z][0-9]"), F.lit(40.0)),
        "secret_word": flag(F.regexp_like(left, F.lit("token|key|secret|passw|pwd|auth|credential"))),
        "contact_word": flag(F.regexp_like(left, F.lit("phone|call|tel|fax|mobile|mail|contact"))),
        "hash_word": flag(F.regexp_like(left, F.lit(_HASHED))),
        "id_word": flag(F.regexp_like(left, F.lit("card|visa|iban|account|ssn|passport|social"))),
        "assigned": flag(F.regexp_like(left, F.lit("[=:]\\s*[\"']?\\z"))),
        "quoted": flag(left.endswith('"') & right.startswith('"')),
        "inside": flag(F.regexp_like(left, F.lit("[a-z0-9]\\z")) | F.regexp_like(right, F.lit("\\A[A-Za-z0-9]"))),
    }


def weak_label() -> Column:
    """1, 0 or null: what the checks of the base kinds and plain evidence say of a candidate.

    A number of 9 to 12 digits in groups is personal after a word that says so and is not after one that says
    otherwise, or as a date; without such evidence it has no label, also where the pattern of cards found it,
    for a number that is no card may still be another person's number. A long string is a secret after a name
    and an equals sign, and none after a word for hashes, behind a slash, or without letters or digits. A spelled
    address is one if it ends in a domain; nothing labels one as none, so its threshold rests on those alone.
    """
    match, left = F.col("match"), F.lower("left")
    mixed = F.regexp_like("match", F.lit("[0-9]")) & F.regexp_like("match", F.lit("[A-Za-z]"))
    named = F.regexp_like(left, F.lit("(?:token|key|secret|passw|pwd|auth)[a-z_]*[\"']?\\s*[=:]\\s*[\"']?\\z"))
    grouped = F.regexp_count(match, F.lit("[0-9]")).between(9, 12) & F.regexp_like(match, F.lit("[^0-9]"))
    other = F.regexp_like(left, F.lit(_OTHER)) | F.regexp_like(match, F.lit(_DATED))
    numeric = F.col("kind").isin("number", "card") & ~F.col("valid")
    hashed = F.regexp_like(left, F.lit(_HASHED))
    return (
        F.when(numeric & other, 0)
        .when(numeric & grouped, F.when(F.regexp_like(left, F.lit(_NAMED)), 1))
        .when(F.col("kind").isin(BASE), F.col("valid").cast("int"))
        .when((F.col("kind") == "secret") & named & mixed, 1)
        .when((F.col("kind") == "secret") & (hashed | ~mixed), 0)
        .when((F.col("kind") == "address") & F.regexp_like(match, F.lit(_DOMAIN)), 1)
    )


def _threshold(bins: list[tuple[int, float, int]]) -> float:
    """The lowest score above which labelled candidates are right in ``PRECISION``; above all scores if there is none."""
    good = n = 0.0
    threshold = 1.1
    for at, right, rows in sorted(bins, reverse=True):
        good, n = good + right, n + rows
        if (good + 1) / (n + 2) >= PRECISION:
            threshold = at / BINS
    return threshold


def stands() -> Column:
    """Matches of the base kinds that pass their checks: they are spans whatever the trees say."""
    return F.col("kind").isin(BASE) & F.col("valid")


def fit(candidates: DataFrame) -> tuple[GBTClassificationModel, dict[str | None, float]] | None:
    """Trees and the scores from which proposals are taken; None if the labels hold one class only.

    Fitted on all labelled candidates but those of a fold of a fourth, dealt by hash, which calibrates: of it
    only proposals count, not the matches that stand anyway. A kind with ``FOLD_ROWS`` of them has a
    threshold of its own, the others share that of all proposals (key None).
    """
    labelled = candidates.withColumn("label", weak_label().cast("double")).where("label is not null")
    drawn = labelled.withColumn("_draw", F.xxhash64("match", "left", "right", "kind"))
    drawn = materialise(drawn.select("vector", "label", "_draw", "kind", stands().alias("_stands")))
    fold = F.pmod("_draw", F.lit(4)) == 0
    classes = drawn.where(~fold).groupBy("label").count().collect()
    if len(classes) < 2:
        return None
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=0.3, seed=1)
    model = trees.fit(drawn.where(~fold))
    bins = (
        model.transform(drawn.where(fold & ~F.col("_stands")))
        .withColumn("_bin", F.floor(vector_to_array("probability")[1] * BINS))
        .groupBy("kind", "_bin")
        .agg(F.sum("label").alias("good"), F.count("*").alias("n"))
        .collect()
    )
    of_kind: dict[str | None, list[tuple[int, float, int]]] = {None: [(r["_bin"], r["good"], r["n"]) for r in bins]}
    for r in bins:
        of_kind.setdefault(r["kind"], []).append((r["_bin"], r["good"], r["n"]))
    return model, {kind: _threshold(own) for kind, own in of_kind.items() if kind is None or sum(b[2] for b in own) >= FOLD_ROWS}


def settled(base: DataFrame, taken: DataFrame) -> DataFrame:
    """The candidates of ``taken`` that stay: best first, each that overlaps none that stays already.

    Candidates that lie within a base span go, for they add nothing to it; those that reach beyond it stay.
    """
    both = base.unionByName(taken)
    seen = Window.partitionBy("_rid").orderBy("start", F.desc("base")).rowsBetween(Window.unboundedPreceding, 0)
    covered = both.withColumn("_covered", F.max(F.when(F.col("base"), F.col("end"))).over(seen))
    loose = covered.where(~F.col("base") & (F.col("_covered").isNull() | (F.col("end") > F.col("_covered")))).drop("_covered")
    line = Window.partitionBy("_rid").orderBy("start", F.desc("end"), "kind")
    reach = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.when(F.col("start") < reach, 0).otherwise(1)).over(line.rowsBetween(Window.unboundedPreceding, 0))
    place = F.struct((-F.col("score")).alias("below"), F.col("kind").isin(BASE).alias("failed"), "start", (-F.col("end")).alias("to"), "kind", "end", "score")
    runs = loose.withColumn("_run", run).groupBy("_rid", "_run").agg(F.array_sort(F.collect_list(place)).alias("found"))
    kept = F.aggregate(
        "found",
        F.slice("found", 1, 0),
        lambda a, s: F.when(F.exists(a, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"])), a).otherwise(F.concat(a, F.array(s))),
    )
    return runs.select("_rid", F.inline(kept)).select("_rid", "kind", "start", "end", F.lit(False).alias("base"), "score")


def detected(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` with ``_rid``, and their spans ``_rid, kind, start, end, base, score``.

    Spans of the base kinds that pass their checks always stand (``base``). Of what the generators
    propose besides, the trees' score decides; where taken candidates overlap, the best score stays,
    ties to the generators' kinds, then the first; only those that overlap one that stays go (``settled``). Positions are code points, the end
    exclusive. A null or empty text has no spans; repeated rows get each their own. No row is dropped.
    """
    docs = without(docs, "_rid")
    rows = docs.withColumn("_rid", F.monotonically_increasing_id())
    # Numbered rows are written, for the numbers follow the layout of the tasks.
    rows = materialise(rows)
    texts = rows.select("_rid", F.col("text").cast("string").alias("text")).where("text is not null and text != ''")
    found = proposals(texts, BASE + PROPOSED)
    digits = F.regexp_replace("match", "[^0-9]", "")
    checked = found.withColumn("valid", F.when(F.col("kind") == "number", luhn(digits)).otherwise(valid()))
    shapes = features()
    columns = checked.withColumns({f"f_{n}": c for n, c in shapes.items()})
    vector = VectorAssembler(inputCols=[f"f_{n}" for n in shapes], outputCol="vector")
    candidates = materialise(vector.transform(columns).drop(*[f"f_{n}" for n in shapes]))
    base = candidates.where(stands()).select(
        "_rid", "kind", "start", "end", F.lit(True).alias("base"), F.lit(1.0).alias("score")
    )
    fitted = fit(candidates)
    if fitted is None:
        return rows, base
    model, thresholds = fitted
    threshold = F.lit(thresholds[None])
    for kind, own in thresholds.items():
        if kind is not None:
            threshold = F.when(F.col("kind") == kind, own).otherwise(threshold)
    scored = model.transform(candidates.where(~stands()))
    taken = scored.withColumn("score", vector_to_array("probability")[1]).where(F.col("score") >= threshold)
    taken = taken.select("_rid", "kind", "start", "end", F.lit(False).alias("base"), "score")
    return rows, base.unionByName(settled(base, taken))


def digest(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["place"], s["end"], s["kind"])))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def with_spans(docs: DataFrame) -> DataFrame:
    """Columns of ``docs`` with ``pii``: an array of ``start, place, end, kind, base, score`` per row."""
    docs = without(docs, "pii")
    names = docs.columns
    rows, spans = detected(docs)
    place = F.array_position(F.array(*[F.lit(k) for k in BASE + PROPOSED]), F.col("kind"))
    lists = spans.groupBy("_rid").agg(F.collect_list(F.struct("start", place.alias("place"), "end", "kind", "base", "score")).alias("pii"))
    lists = materialise(lists)
    empty = F.array().cast(lists.schema["pii"].dataType)
    return lookup(rows, lists, "_rid").select(*[quoted(c) for c in names], F.coalesce("pii", empty).alias("pii"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; ``n_chars``, if present, is counted anew.

    Overlapping spans are replaced as one, by the kind of the first.
    """
    found = with_spans(docs)
    text = F.col("text").cast("string")
    order = F.array_sort("pii")
    done = F.aggregate(
        order,
        F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("end")),
        lambda a, s: F.when(
            s["start"] >= a["end"],
            F.struct(
                F.concat(
                    a["parts"],
                    F.array(
                        F.substring(text, a["end"] + 1, s["start"] - a["end"]),
                        F.concat(F.lit("<"), s["kind"], F.lit(">")),
                    ),
                ).alias("parts"),
                s["end"].alias("end"),
            ),
        ).otherwise(F.struct(a["parts"].alias("parts"), F.greatest(a["end"], s["end"]).alias("end"))),
        lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(text, a["end"] + 1, F.length(text))),
    )
    out = found.withColumn("text", F.when(F.size("pii") > 0, done).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("pii") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*[quoted(c) for c in docs.columns])
