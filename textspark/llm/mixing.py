"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.llm.common import WORD, quoted, running_total, without, word_count
from textspark.operators.lookup import lookup
from textspark.operators.rank import global_rank
from textspark.session import materialise

BLOCK = 16  # words of a block; a walk is cut at block ends, so this is its precision
MAX_EPOCHS = 3  # how often the mix may take one word


def weighted(sources: DataFrame) -> DataFrame:
    """Add ``_rank`` (by code point, the null source last) and ``weight`` 1, 2, 3, 1, …"""
    ranked = global_rank(sources, ["_null", "_source"], "_rank")
    return ranked.withColumn("weight", (F.col("_rank") % 3 + 1).cast("double"))


def targets(sources: DataFrame) -> DataFrame:
    """Add ``target``: shares of all words by weight, none above ``MAX_EPOCHS`` times its source.

    The excess of capped sources goes to the others by weight until none is above. Each round is one
    aggregate over the source table; capped sources only grow in number, so the rounds end.
    """
    total, capped = None, -1
    level = 0.0  # words per unit of weight for sources that aren't capped
    cap = F.col("source_size") * float(MAX_EPOCHS)
    while True:
        over = cap <= F.col("weight") * level if total is not None else F.lit(False)
        got = sources.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(over, cap).otherwise(0.0)).alias("held"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.count_if(over).alias("n"),
        ).first()
        if total is not None and got["n"] == capped:
            break
        total, capped = got["total"] or 0, got["n"] if total is not None else -1
        level = (total - (got["held"] or 0.0)) / got["open"] if got["open"] else level
    return sources.withColumn("target", F.least(cap, F.col("weight") * level))


def apportion(sources: DataFrame, shards: int, block: int = BLOCK) -> DataFrame:
    """Add ``_quota``: cumulative blocks of the source at the end of each shard, by Sainte-Laguë.

    All blocks are awarded one by one to the source with the highest quotient ``target / (2 k + 1)``,
    ``k`` its blocks so far, ties to the first source; a source whose ``MAX_EPOCHS`` passes are used up
    leaves the contest. Shard ``j`` gets the ``j``-th equal run of awards, so its quota per source is an
    integer and every prefix of shards is itself a Sainte-Laguë result. Only the awards that the common
    divisor leaves in doubt are ranked: each source enters with its share of about 3 awards per source.
    """
    got = sources.agg(F.sum("source_size").alias("t"), F.sum("target").alias("m"), F.count("*").alias("s")).first()
    total, mass, many = got["t"] or 0, got["m"] or 0.0, got["s"]
    blocks = total // block
    if not blocks or not mass:
        return sources.withColumn("_quota", F.array_repeat(F.lit(0).cast("long"), shards))
    house = F.floor(F.lit(float(blocks)) * (F.col("shard") + 1) / shards).cast("long")
    fair = F.col("target") * F.col("house") / mass
    doubt = F.ceil(fair / F.greatest(F.col("house"), F.lit(1)) * (3 * many)) + 3
    most = F.floor(F.col("source_size") * MAX_EPOCHS / block).cast("long")
    calls = (
        sources.select("_rank", "target", "source_size", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
        .withColumn("house", house)
        .withColumn("most", most)
        .withColumn("sure", F.greatest(F.lit(0), F.least(F.col("most"), F.round(fair).cast("long") - doubt)).cast("long"))
        .withColumn("last", F.least(F.col("most"), F.round(fair).cast("long") + doubt).cast("long"))
    )
    open_ = materialise(calls)
    rest = open_.groupBy("shard").agg((F.max("house") - F.sum("sure")).alias("_rest"))
    awards = (
        open_.where("last > sure")
        .select("shard", "_rank", "target", F.explode(F.sequence(F.col("sure"), F.col("last") - 1)).alias("k"))
        .select("shard", "_rank", "k", (F.col("target") / (2 * F.col("k") + 1)).alias("quotient"))
    )
    ranked = global_rank(awards, ["shard", F.desc("quotient"), "_rank", "k"], "_at")
    first = ranked.groupBy("shard").agg(F.min("_at").alias("_first"))
    # One row per shard, and their number is a parameter: safe to broadcast.
    won = (
        ranked.join(F.broadcast(first), "shard")
        .join(F.broadcast(rest), "shard")
        .where("_at - _first < _rest")
        .groupBy("shard", "_rank")
        .agg(F.count("*").alias("won"))
    )
    held = (
        open_.select("shard", "_rank", "sure")
        .join(won, ["shard", "_rank"], "left")
        .groupBy("_rank")
        .agg(F.array_sort(F.collect_list(F.struct("shard", (F.col("sure") + F.coalesce("won", F.lit(0))).alias("q")))).alias("_q"))
        .select("_rank", F.col("_q.q").alias("_quota"))
    )
    return sources.join(held, "_rank")


def _overlap(start: Column, size: Column, begin: Column, end: Column) -> Column:
    return F.greatest(F.lit(0), F.least(start + size, end) - F.greatest(start, begin))


def mix_plan(docs: DataFrame, seed: int = 0, shards: int = 8, block: int = BLOCK, carry: bool = False):
    """``doc_id, size, source_size, target, taken, _from, _walk, _at, _quota`` for each row of ``docs``.

    ``size`` counts the words of the text. The documents of a source stand in seeded order, their words
    end to end in a circle that is cut into blocks; the source's quota of blocks is a walk from a
    seeded block on (``_from``, ``_walk`` words), and ``taken`` is what it covers of the document,
    repeats counted: at most ``MAX_EPOCHS`` times its size. Order and start depend on the seed, the id
    and the text alone, so reruns agree. With ``carry`` rows are numbered
    (``_rid``) and a table of them, ``_row`` with the whole row, comes second.

    Null or blank texts have size 0 and are taken 0 times; a source without words has target 0; a null
    source is a source of its own. Equal rows are walked one after the other. An empty table stays empty.
    """
    sized = materialise(
        docs.select(
            "doc_id",
            word_count(F.col("text")).alias("size"),
            F.xxhash64(F.lit(seed), "doc_id", "text").alias("_hash"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source"),
            F.col("source").isNull().alias("_null"),
            *([F.struct(*[quoted(c) for c in docs.columns]).alias("_row"), F.monotonically_increasing_id().alias("_rid")] if carry else []),
        )
    )
    rows, sized = sized, sized.drop("_row")
    sources = sized.groupBy("_null", "_source").agg(F.sum("size").alias("source_size"))
    sources = materialise(apportion(materialise(targets(materialise(weighted(sources)))), shards, block))
    blocks = F.greatest(F.lit(1), F.floor(F.col("source_size") / block)).cast("long")
    walks = sources.select(
        "_null",
        "_source",
        "source_size",
        "target",
        "_quota",
        (F.pmod(F.xxhash64(F.lit(seed), "_null", "_source"), blocks) * block).alias("_from"),
        (F.element_at("_quota", -1) * block).alias("_walk"),
    )
    placed = running_total(sized, ["_null", "_source"], "_hash", ["doc_id"], "size", "_at", extra=walks)
    taken = sum(
        (
            _overlap(F.col("_at") + F.col("source_size") * k, F.col("size"), F.col("_from"), F.col("_from") + F.col("_walk"))
            for k in range(MAX_EPOCHS + 1)
        ),
        F.lit(0),
    )
    plan = placed.withColumn("taken", taken.cast("long"))
    return (plan, rows) if carry else plan


def mixed(docs: DataFrame, seed: int = 0, shards: int = 8, block: int = BLOCK) -> DataFrame:
    """The mix itself: the columns of ``docs`` with one row per visit of the walk, and its ``mix_shard``.

    A document covered whole keeps its text; where a walk begins or ends inside a document, the text
    keeps the covered words with the white space after them, and ``n_chars``, if present, is counted anew.
    Rows nowhere covered go, among them those without words. A column named ``mix_shard`` is replaced.
    """
    docs = without(docs, "mix_shard")
    plan, rows = mix_plan(docs, seed, shards, block, carry=True)
    at = F.col("_at") - F.col("_from")
    lows = lambda k: F.greatest(F.lit(0), F.lit(0) - at - F.col("source_size") * k)
    shard = lambda first: F.size(F.filter("_quota", lambda q: q * block <= first)).cast("int")
    visits = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(MAX_EPOCHS)),
            lambda k: F.struct(
                lows(k).alias("lo"),
                F.least(F.col("size"), F.col("_walk") - at - F.col("source_size") * k).alias("hi"),
                shard(at + F.col("source_size") * k + lows(k)).alias("shard"),
            ),
        ),
        lambda v: v["hi"] > v["lo"],
    )
    # Only places move; texts stay where they are unless the places are too many to broadcast.
    places = materialise(plan.where("taken > 0").select("_rid", visits.alias("_visits")))
    out = lookup(rows.select("_rid", "_row", "size"), places, "_rid", "inner").select("_row", "size", F.explode("_visits").alias("v"))
    lo, words = F.col("v.lo"), F.col("v.hi") - F.col("v.lo")
    whole = words == F.col("size")
    text = F.col("_row.text")
    pieces = F.regexp_extract_all(text, F.lit(f"({WORD}[\\x20\\x09-\\x0D]*)"), F.lit(1))
    cut = F.array_join(F.slice(pieces, (lo + 1).cast("int"), words.cast("int")), "")
    out = out.withColumn("_text", F.when(whole, text).otherwise(cut))
    chars = F.when(whole, F.col("_row.n_chars")).otherwise(F.length("_text").cast("long")) if "n_chars" in docs.columns else None
    new = {"text": F.col("_text"), "n_chars": chars}
    return out.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns], F.col("v.shard").alias("mix_shard"))
