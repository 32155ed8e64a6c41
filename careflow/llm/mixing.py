"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careflow.llm.common import cut
from careflow.operators.running import with_total_before

#: A document is taken so often at most, and a source so many times its size.
REPEATS = 3
#: The table of sources is broadcast up to this size, else joined by shuffle.
BROADCAST_BYTES = 8 << 20
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``src, source_size, place, target`` from one row per source (``src, source_size, n_docs``).

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share the total of all sizes;
    a target stops at ``REPEATS`` times its source's size and the excess is shared by weight until
    none is above.  The level at which this ends comes from running sums over sources in order of
    cap per weight: the sources below the level are those that are capped.  Sources are numbered
    and summed by ranges; only one sum per range meets in one place.
    """
    named = with_total_before(sizes.withColumn("unnamed", F.col("src").isNull()), ["unnamed", "src"], F.lit(1))
    weighed = (
        named.withColumn("place", F.col("_before") + 1).drop("_before", "unnamed")
        .withColumn("weight", (F.col("place") - 1) % 3 + 1)
        .withColumn("cap", F.col("source_size") * REPEATS)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    for name in ("cap", "weight"):
        weighed = with_total_before(weighed, ["ratio", "place"], F.col(name)).withColumnRenamed("_before", f"{name}_before")
    weighed = cut(weighed)
    whole = weighed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    # The level if this source and those with larger ratios were not capped.
    here = (F.lit(whole["size"]) - F.col("cap_before")) / (F.lit(whole["weight"]) - F.col("weight_before"))
    found = (
        weighed.withColumn("level", here).where(F.col("cap") >= F.col("level") * F.col("weight"))
        .agg(F.min(F.struct("ratio", "place", "level"))["level"].alias("level")).first()
    )
    level = F.lit(found["level"]).cast("double")
    return weighed.withColumn("target", F.coalesce(
        F.when(F.col("cap") >= level * F.col("weight"), level * F.col("weight")), F.col("cap").cast("double"))
    ).select("src", "n_docs", "source_size", "place", "target")


def mix_sources(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text, source``): ``doc_id, text_hash, source, size,
    source_size, target, taken``.

    Documents of a source queue in the order of a hash of their id, again for each repeat.  A
    document's virtual finish time is its source's words up to and with it divided by the target;
    all are ordered by that time and taken while the total stays within the total of all sizes.
    ``taken`` counts words, repeats included.  Ties are settled by place of the source, repeat,
    hash of id and hash of text; fully equal rows queue one after another.  Null text has size 0, a null
    source is a source of its own; other columns are ignored; an empty table gives no row.

    No source is collected: words are summed per hash bucket first, about as many buckets of a
    source as documents in a bucket, then within buckets; the order by time is cut the same way.
    Rows without an id have one place in the queue and are dealt out by hash of text there.
    """
    unnamed = F.md5(F.lit("null"))
    draw = F.coalesce(F.md5(F.col("doc_id").cast("string")), unnamed)
    items = cut(docs.select(
        "source", "doc_id", n_words(F.col("text")).alias("size"), draw.alias("draw"),
        F.xxhash64("text").alias("text_hash")))
    sources = source_targets(cut(items.groupBy(F.col("source").alias("src")).agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))))
    shape = sources.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)).alias("budget"),
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
        F.coalesce(F.sum(F.lit(64) + F.coalesce(F.octet_length("src"), F.lit(0))), F.lit(0)).alias("bytes"),
    ).first()
    if shape["bytes"] <= BROADCAST_BYTES:
        sources = F.broadcast(sources)
    u = F.conv(F.substring("draw", 1, 13), 16, 10).cast("double") / float(16 ** 13)
    v = F.col("text_hash").cast("double") / 2.0 ** 64 + 0.5
    parts = F.ceil(F.sqrt("n_docs"))
    # Before, at and after the place of rows without an id; monotone in (draw, text_hash).
    side = F.when(F.col("draw") < unnamed, 0).when(F.col("draw") == unnamed, 1).otherwise(2)
    buckets = ["bucket", "side", "part"]
    placed = (
        items.join(sources, F.col("source").eqNullSafe(F.col("src"))).drop("src")
        .withColumn("bucket", F.floor(u * parts)).withColumn("side", side)
        .withColumn("part", F.when(F.col("side") == 1, F.floor(v * parts)).otherwise(0))
    )
    offsets = (
        placed.groupBy("place", *buckets).agg(F.sum("size").alias("words"))
        .select("place", *buckets, F.coalesce(F.sum("words").over(
            Window.partitionBy("place").orderBy(*buckets).rowsBetween(Window.unboundedPreceding, -1)
        ), F.lit(0)).alias("before"))
    )
    to_here = (Window.unboundedPreceding, Window.currentRow)
    within = Window.partitionBy("place", *buckets).orderBy("draw", "text_hash").rowsBetween(*to_here)
    queue = cut(
        placed.withColumn("upto", F.sum("size").over(within))
        .join(offsets, ["place", *buckets])
        .withColumn("upto", F.col("upto") + F.col("before"))
        .select("doc_id", "text_hash", "source", "size", "source_size", "target", "place", "draw", "upto")
    )
    order = ["finish", "place", "again", "draw", "text_hash"]
    turns = F.transform(F.sequence(F.lit(0), F.lit(REPEATS - 1)), lambda again: F.struct(
        ((again * F.col("source_size") + F.col("upto")) / F.col("target")).alias("finish"),
        F.col("place"), again.alias("again"), F.col("draw"), F.col("text_hash")))
    turns = F.when(F.col("size") > 0, F.filter(
        turns, lambda t: t["again"] * F.col("source_size") <= F.col("target"))).otherwise(F.array())
    slots = max(1, math.isqrt(REPEATS * shape["n_docs"]))
    timed = queue.select("size", F.explode(turns).alias("turn")).select("size", "turn.*").withColumn(
        "slot", F.floor(F.col("finish") * slots))
    total = F.sum("words").over(Window.partitionBy(F.lit(0)).orderBy("slot"))
    full = (
        timed.groupBy("slot").agg(F.sum("size").alias("words")).withColumn("total", total)
        .where(F.col("total") > shape["budget"]).orderBy("slot").first()
    )
    if full is None:
        fits = F.size(turns)
    else:
        in_slot = Window.partitionBy("slot").orderBy(*order).rowsBetween(*to_here)
        so_far = F.sum("size").over(in_slot) + F.lit(full["total"] - full["words"])
        last = (
            timed.where(F.col("slot") == full["slot"]).withColumn("so_far", so_far)
            .where(F.col("so_far") <= shape["budget"])
            .orderBy(*[F.col(c).desc() for c in order]).select(*order).first()
        )
        if last is None:
            fits = F.size(F.filter(turns, lambda t: F.floor(t["finish"] * slots) < full["slot"]))
        else:
            types = queue.select(F.explode(turns).alias("turn")).select("turn.*").schema
            end = F.struct(*[F.lit(last[c]).cast(types[c].dataType).alias(c) for c in order])
            fits = F.size(F.filter(turns, lambda t: t <= end))
    return queue.select(
        "doc_id", "text_hash", "source", "size", "source_size", "target",
        (F.col("size") * fits).cast("long").alias("taken"))
