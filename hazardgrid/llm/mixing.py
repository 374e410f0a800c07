"""Mixing sources to target weights, by DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardgrid.llm.common import WORD, fresh, null_last, saved, shuffles

#: Weights of the sources in order, repeating, and the shares of the sizes (values of the contract).
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0


def words(text: str = "text") -> Column:
    """Number of runs without white space; null counts as empty."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def prefix_sums(df: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows before each row of its group, in ``order``, saved.

    Rows are dealt by ranges of (group, order), so a group that holds most rows covers many ranges.
    The range totals, one row per range and group, are summed up to give each range its start;
    within a range a window does the rest.
    """
    spark = df.sparkSession
    ranges = df.repartitionByRange(shuffles(spark), *group, *order).withColumn("_range", F.spark_partition_id())
    ranges = saved(ranges, "ranges")
    totals = ranges.groupBy("_range", *group).agg(F.sum(value).alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("_range", *group, F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.sum(value).over(Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    placed = ranges.withColumn(out, F.coalesce(inside, F.lit(0)))
    return placed.join(starts, ["_range", *group]).withColumn(out, F.col(out) + F.col("_start")).drop("_range", "_start")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Budget of every source from its ``size``: ``_source``, ``source_size``, ``target``.

    Sources in order of code point, null last, have ``weights`` in turn. ``share`` of all sizes is dealt
    by weight; what would exceed ``most`` times a source's size goes to the others by weight, until
    nothing does. The level of that rule in closed form: sources in order of size by weight reach
    their limit first, so one is limited if its limit is below its part of what those before left.
    Sources are rows of a grouped table: its windows hold one row for each source.
    """
    pick = F.get(F.lit(list(map(float, weights))), ((F.col("_rank") - 1) % len(weights)).cast("int"))
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy("_source"))).withColumn("_weight", pick)
    ranked = ranked.withColumn("_limit", F.col("source_size") * F.lit(float(most)))
    by_level = Window.orderBy(F.col("_limit") / F.col("_weight"), "_rank")
    ahead = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everyone) * F.lit(float(share)) - F.coalesce(F.sum("_limit").over(ahead), F.lit(0.0))
    rest = F.sum("_weight").over(everyone) - F.coalesce(F.sum("_weight").over(ahead), F.lit(0.0))
    leveled = ranked.withColumn("_level", left / rest)
    leveled = leveled.withColumn("_free", F.col("_level") * F.col("_weight") < F.col("_limit"))
    # The first source below its limit in this order sets the level of all that follow.
    level = F.min_by("_level", F.when(F.col("_free"), F.struct(F.col("_limit") / F.col("_weight"), F.col("_rank")))).over(everyone)
    budget = F.when(F.col("_limit") <= level * F.col("_weight"), F.col("_limit")).otherwise(level * F.col("_weight"))
    return leveled.withColumn("target", F.coalesce(budget, F.col("_limit"))).select("_source", "source_size", "target")


def mix(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), seed: str = "mix", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """How many words of every document a mix of the sources takes, repeats counted.

    Documents (``doc_id``, ``text``, ``source``) of a source follow each other in the order of a random key,
    the MD5 of seed and id; their sizes are summed up in that order, the source is repeated as
    often as its budget needs, and the last turn is cut where the budget (rounded down) is spent.
    Returns ``keep``, ``source``, ``size``, ``source_size``, ``target``, ``taken``: one row per row of ``docs``,
    repeated rows and rows without id or source included. Empty and null texts have size 0 and take
    0 words; a source of empty texts has target 0. Nothing depends on partitions, so reruns agree.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    names = [f"_keep{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], null_last("source").alias("_source"), key.alias("_key"), words().alias("size"))
    placed = prefix_sums(rows, ["_source"], ["_key", *names, "size"], "size", "_before")
    sizes = placed.groupBy("_source").agg(F.sum("size").alias("source_size"))
    budgets = saved(targets(sizes, weights, share, most), "budgets")
    budget = F.floor("target").cast("long")
    turns = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    last = F.least(F.greatest(budget - F.col("_turns") * F.col("source_size") - F.col("_before"), F.lit(0)), F.col("size"))
    mixed = placed.join(budgets, "_source").withColumn("_turns", turns)
    return mixed.select(
        *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)],
        F.col("_source.value").alias("source"),
        "size", "source_size", "target",
        (F.col("_turns") * F.col("size") + last).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as whole documents: each as often as ``mix`` takes it, the cut one rounded half up.

    Documents without words are in no mix. Rows that agree in id, source and text are taken alike,
    as often as the one of them the mix takes most.
    """
    key, text, source, times = (fresh(docs, name) for name in ("_id", "_text", "_from", "_times"))
    taken = mix(docs.select("doc_id", "source", "text", F.xxhash64("text").alias("key")), ("doc_id", "key"), **options)
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    taken = taken.filter("size > 0").groupBy(null_last("doc_id").alias(key), F.col("key").alias(text), null_last("source").alias(source))
    taken = taken.agg(F.max(copies).alias(times)).filter(F.col(times) > 0)
    marked = docs.withColumns({key: null_last("doc_id"), text: F.xxhash64("text"), source: null_last("source")})
    return marked.join(taken, [key, text, source]).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
