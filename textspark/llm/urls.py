"""URL filters: a tree of path templates per host, pruned by smoothed labelled purity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.llm.common import quoted, without
from textspark.operators.lookup import lookup
from textspark.session import materialise

DEPTH = 8  # segments of a template; what lies deeper counts as one segment
VALUES = 16  # more values than this under one branch make a variable segment, but for those that stand out
LITERALS = 64  # a value of less than this part of its branch does not stand out, which bounds the siblings
SMOOTHING = 20.0  # pseudo-labels that pull a branch towards its parent
REJECT = 0.2  # smoothed share of good labels below which a template is rejected
SIMILAR = 2.0  # branches whose shares differ by fewer standard errors are merged

# Verdict, host, path. A rule fits its host, all subdomains and paths that start with its own.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text and its verdict; nulls where none fits. The rules are literals."""
    rule = verdict = F.lit(None).cast("string")
    for decision, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def shape(segment: Column) -> Column:
    """Values that differ only in numbers or long identifiers get one form."""
    identifiers = F.regexp_replace(segment, "(?i)[0-9a-f]{8}(?:-?[0-9a-f]{4}){2,}[0-9a-f-]*", "{x}")
    return F.regexp_replace(identifiers, "[0-9]+", "{n}")


def _alike(a: Column, b: Column) -> Column:
    """Two-sample tests of two branches: good labels, pages that end here, variable next segments, different ones.

    Shares that differ by at most ``SIMILAR`` standard errors of the pooled share are alike, also where one has no rows.
    """

    def same(hits: str, rows: Callable[[Column], Column]) -> Column:
        x, y, n, m = a[hits], b[hits], rows(a), rows(b)
        pooled = (x + y) / F.greatest(n + m, F.lit(1))
        error = F.sqrt(pooled * (1 - pooled) * (1 / F.greatest(n, F.lit(1)) + 1 / F.greatest(m, F.lit(1))))
        far = F.abs(x / F.greatest(n, F.lit(1)) - y / F.greatest(m, F.lit(1))) > SIMILAR * error + 1e-9
        return ~((n > 0) & (m > 0) & far)

    return same("good", lambda c: c["good"] + c["bad"]) & same("ends", lambda c: c["n"]) & same("varied", lambda c: c["n"]) & same("kids", lambda c: c["n"])


SUMS = ["n", "good", "bad", "ends", "varied", "kids"]


def _merged(siblings: Column) -> Column:
    """Classes of like branches: the largest branch first, each joins the first class it is like, whose sums then grow."""

    def both(k: Column, s: Column) -> Column:
        return F.struct(*[(k[c] + s[c]).alias(c) for c in SUMS], F.concat(k["members"], F.array(s["value"])).alias("members"))

    def add(classes: Column, s: Column) -> Column:
        fits = F.transform(classes, lambda k: _alike(k, s))
        at = F.array_position(fits, F.lit(True))
        alone = F.struct(*[s[c].alias(c) for c in SUMS], F.array(s["value"]).alias("members"))
        return F.when(at > 0, F.transform(classes, lambda k, i: F.when(i + 1 == at, both(k, s)).otherwise(k))).otherwise(F.concat(classes, F.array(alone)))

    kind = "array<struct<" + ",".join(f"{c}:bigint" for c in SUMS) + ",members:array<string>>>"
    return F.aggregate(siblings, F.array().cast(kind), add)


def segments(values: DataFrame) -> DataFrame:
    """What each value of ``host, template, value`` and its sums is called in templates: ``segment``.

    Of more than ``VALUES`` values under one branch those at or below twice an even share, or below
    1/``LITERALS`` of the branch, are one wildcard. The others, fewer than ``LITERALS``, and the wildcard are
    siblings; like ones are merged and named by all their members.
    """
    branch = ["host", "template"]
    total = values.groupBy(*branch).agg(F.sum("n").alias("_of"), F.count("*").alias("_values"))
    total = materialise(total.select(F.struct(*branch).alias("_branch"), "_of", "_values"))
    placed = lookup(values.withColumn("_branch", F.struct(*branch)), total, "_branch", weight="_values")
    rare = (F.col("n") * F.col("_values") <= 2 * F.col("_of")) | (F.col("n") * LITERALS <= F.col("_of"))
    name = F.when((F.col("_values") > VALUES) & rare, "*").otherwise(F.col("value"))
    named = materialise(placed.withColumn("_name", name).select(*branch, "value", "_name", "shapes", *SUMS))
    sibling = named.groupBy(*branch, F.col("_name").alias("value")).agg(*[F.sum(c).alias(c) for c in SUMS])
    line = F.sort_array(F.collect_list(F.struct(F.struct((-F.col("n")).alias("first"), "value").alias("order"), *SUMS, "value")))
    classes = sibling.groupBy(*branch).agg(_merged(line).alias("classes"))
    listed = classes.select(*branch, F.explode("classes").alias("c"))
    listed = listed.select(*branch, F.array_join(F.array_sort("c.members"), "|").alias("segment"), F.explode("c.members").alias("_name"))
    many = named.groupBy(*branch, "_name").agg(F.count("*").alias("_many"))
    listed = materialise(listed.join(many, [*branch, "_name"]).select(F.struct(*branch, "_name").alias("_at"), "segment", "_many"))
    return lookup(named.withColumn("_at", F.struct(*branch, "_name")), listed, "_at", "inner", weight="_many").select(*branch, "value", "segment", "shapes")


def templates(counts: DataFrame) -> DataFrame:
    """From ``host, shape, n, good, bad`` rows, unique by host and shape, to the template of each.

    The tree grows level by level: under each branch of a host, rare values become a wildcard and like
    branches are merged (``segments``). Every level is some pre-aggregated groupings of the shapes, not of the
    pages. The ``DEPTH``-th segment holds all that lies deeper.
    """
    part = F.split("shape", "/", DEPTH + 1)
    tree = counts.withColumn("_parts", part).withColumn("template", F.lit(""))
    deepest = counts.agg(F.max(F.size(part))).first()[0] or 0
    for level in range(deepest):
        branch = ["host", "template"]
        here = tree.withColumn("value", F.get("_parts", F.lit(level)))
        next_ = F.coalesce(F.get("_parts", F.lit(level + 1)), F.lit(""))
        sums = [F.sum(c).cast("long").alias(c) for c in ("n", "good", "bad")]
        kids = here.where("value is not null").groupBy(*branch, "value", next_.alias("next")).agg(*sums, F.count("*").alias("shapes"))
        sums += [F.sum(F.when(c, F.col("n")).otherwise(0)).cast("long").alias(name) for name, c in (("ends", F.col("next") == ""), ("varied", F.col("next").contains("{")))]
        sums += [F.count_if(F.col("next") != "").alias("kids"), F.sum("shapes").alias("shapes")]
        values = kids.groupBy(*branch, "value").agg(*sums)
        found = materialise(segments(materialise(values)).select(F.struct(*branch, "value").alias("_at"), "segment", "shapes"))
        named = lookup(here.withColumn("_at", F.struct(*branch, "value")), found, "_at", weight="shapes")
        grown = F.concat("template", F.lit("/" if level else ""), F.col("segment"))
        tree = materialise(named.withColumn("template", F.coalesce(grown, F.col("template"))).drop("_at", "value", "segment", "shapes"))
    return tree.drop("_parts")


def _share(good: Column, bad: Column, prior: Column) -> Column:
    return (good + SMOOTHING * prior) / (good + bad + SMOOTHING)


def purity(tree: DataFrame) -> DataFrame:
    """``host, template, purity``: the smoothed share of good labels.

    Like branches are merged across hosts: the labels of a template at all hosts give its prior if they
    tell it apart from the corpus, else the corpus does; hosts whose share is statistically similar
    to that of the merged branch take the merged share, others keep their own, smoothed towards it.
    """
    nodes = materialise(tree.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")]))
    whole = nodes.agg(F.sum("good").alias("g"), F.sum("bad").alias("b")).first()
    base = F.lit(((whole["g"] or 0) + 1.0) / ((whole["g"] or 0) + (whole["b"] or 0) + 1.0))
    merged = nodes.groupBy("template").agg(F.sum("good").alias("_g"), F.sum("bad").alias("_b"), F.count("*").alias("_hosts"))
    merged = materialise(merged.withColumn("_all", _share(F.col("_g"), F.col("_b"), base)).select("template", "_all", "_hosts"))
    labelled = F.col("good") + F.col("bad")
    own = F.col("good") / F.greatest(labelled, F.lit(1))
    error = F.sqrt(F.col("_all") * (1 - F.col("_all")) / F.greatest(labelled, F.lit(1)))
    similar = (labelled == 0) | (F.abs(own - F.col("_all")) <= SIMILAR * error)
    return lookup(nodes, merged, "template", "inner", weight="_hosts").select(
        "host",
        "template",
        F.when(similar, F.col("_all")).otherwise(_share(F.col("good"), F.col("bad"), F.col("_all"))).alias("purity"),
    )


def judged(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    label: Column | None = None,
    reject: float = REJECT,
) -> DataFrame:
    """Columns of ``pages`` with ``host, path, rule, template, purity, verdict``.

    A rule that fits decides. For other pages the template does: it blocks where the smoothed share of
    good labels is under ``reject``. ``label`` is a boolean column (null: none); by default the rules
    label the pages they decide. A null url, or one without ``://``, has an empty host and path, and is
    a template like any other; repeated rows count each. Segments beyond the ``DEPTH``-th are one. Columns with the names of results are
    replaced. An empty table stays empty.
    """
    pages = without(pages, "host", "path", "rule", "template", "purity", "verdict", "shape", "_verdict", "_label")
    url = F.col("url").cast("string")
    found = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    found = found.withColumns({"rule": rule, "_verdict": verdict, "shape": shape(F.col("path"))})
    found = found.withColumn("_label", label if label is not None else F.col("_verdict") == "allow")
    counts = materialise(
        found.groupBy("host", "shape").agg(
            F.count("*").alias("n"), F.count_if(F.col("_label")).alias("good"), F.count_if(~F.col("_label")).alias("bad")
        )
    )
    tree = templates(counts)
    # One row per host and shape, with the pages behind it: broadcast if small, else hot shapes are salted.
    shapes = tree.groupBy("host", "template").agg(F.count("*").alias("_shapes"))
    leaf = materialise(purity(tree).join(shapes, ["host", "template"]).select(F.struct("host", "template").alias("_leaf"), "purity", "_shapes"))
    leaves = lookup(tree.select("host", "shape", "template", "n", F.struct("host", "template").alias("_leaf")), leaf, "_leaf", "inner", weight="_shapes")
    known = materialise(leaves.select(F.struct("host", "shape").alias("_at"), "template", "purity", "n"))
    out = lookup(found.withColumn("_at", F.struct("host", "shape")), known, "_at", weight="n")
    decided = F.coalesce("_verdict", F.when(F.col("purity") < reject, "block").otherwise("allow"))
    return out.withColumn("verdict", decided).select(
        *[quoted(c) for c in pages.columns], "host", "path", "rule", "template", "purity", "verdict"
    )
