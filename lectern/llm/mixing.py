"""Mixing sources to target weights of tokens.

Every document gets a hash-random key; the key's leading bits give its range
within the source, so that a hot source is spread over all ranges. Prefix sums
of token counts are taken within each range and offset by the sums of the
ranges before it, of which there is a fixed number per source. A source's
budget is met by whole epochs and a last one that is cut where its budget ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.tokens import encode_texts
from lectern.session import materialize

RANGES = 1024


def sized(docs: DataFrame, **vocabulary: str) -> DataFrame:
    """``(doc_id, source, tokens, part, key)``, written once, as sizes are costly."""
    counted = encode_texts(docs.select("doc_id", "source", "text"), count_only=True, **vocabulary)
    key = F.xxhash64(F.col("doc_id").cast("string"), F.lit("mix"))
    return materialize(counted.withColumn("key", key).withColumn("part", F.pmod(F.shiftrightunsigned("key", 54), F.lit(RANGES)).cast("int")), "sized")


def plan_of(sizes: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """A row for each source of either table, with its budget.

    Weights are shares of the weights' sum over the targets that have tokens;
    null and negative weights count as 0, several rows of a target as their
    sum of weights and largest number of repeats. ``total`` is the size wanted,
    by default all tokens of the sources with a weight. A null or smaller
    ``max_repeats`` allows 1 use of a document; a source's limit is all of its
    tokens so many times. Documents without a source have no target.
    """
    wanted = targets.where(F.col("source").isNotNull()).groupBy("source").agg(
        F.sum(F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0))).alias("weight"), F.greatest(F.coalesce(F.max("max_repeats"), F.lit(1.0)), F.lit(1.0)).cast("bigint").alias("max_repeats")
    )
    had = sizes.groupBy("source").agg(F.count("*").alias("documents"), F.sum("tokens").alias("available"))
    rows = (
        wanted.withColumnRenamed("source", "target").join(had, F.col("target") == F.col("source"), "full")
        .select(F.coalesce("target", "source").alias("source"), "weight", "max_repeats", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("available", F.lit(0)).alias("available"))
    )
    usable = F.when(F.col("available") > 0, F.coalesce("weight", F.lit(0.0))).otherwise(0.0)
    sums = rows.agg(F.sum(usable).alias("weights"), F.sum(F.when(usable > 0, F.col("available"))).alias("tokens")).first()
    size = total if total is not None else (sums.tokens or 0)
    share = usable / F.lit(sums.weights) if sums.weights else F.lit(0.0)
    return (
        rows.withColumn("target_share", share)
        .withColumn("budget", F.floor(F.col("target_share") * F.lit(size)))
        .withColumn("epochs", F.when(F.col("available") > 0, F.least(F.floor(F.col("budget") / F.col("available")), F.coalesce("max_repeats", F.lit(1)))).otherwise(0).cast("bigint"))
        .withColumn("rest", F.when(F.col("epochs") < F.coalesce("max_repeats", F.lit(1)), F.col("budget") - F.col("epochs") * F.col("available")).otherwise(0))
    )


def mix(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """``(doc_id, source, tokens, repeats)`` of each document that is used; the sum of tokens x repeats never exceeds a budget.

    The last epoch takes the documents of least key while they fit, and stops
    before the first that doesn't. Documents with equal keys go by doc_id.
    Empty documents ride along for free. No document is used more often than its
    source's max_repeats.
    """
    parts = sizes.groupBy("source", "part").agg(F.sum("tokens").alias("in_part"))
    before = F.sum("in_part").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    budgets = plan.where(F.col("budget") > 0).select("source", "epochs", "rest")
    cuts = parts.withColumn("before", F.coalesce(before, F.lit(0))).join(budgets, "source").where((F.col("epochs") > 0) | (F.col("before") < F.col("rest")))
    within = F.sum("tokens").over(Window.partitionBy("source", "part").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    return (
        sizes.withColumn("upto", within)
        .join(cuts.select("source", "part", "before", "epochs", "rest"), ["source", "part"])
        .withColumn("repeats", F.col("epochs") + F.when(F.col("before") + F.col("upto") <= F.col("rest"), 1).otherwise(0))
        .where(F.col("repeats") > 0)
        .select("doc_id", "source", "tokens", "repeats")
    )


def shares(plan: DataFrame, chosen: DataFrame) -> DataFrame:
    """The plan with the documents and tokens reached, for every source of either table.

    ``reached_share`` is the share of all tokens reached. Where some sources
    end below their budget at their limit of repeats, the others' shares of
    what is left rise in proportion; ``share_of_wanted_total`` is the share of
    the size that was wanted.
    """
    reached = chosen.groupBy("source").agg(F.count("*").alias("used_documents"), F.sum(F.col("tokens") * F.col("repeats")).alias("reached_tokens"), F.max("repeats").alias("most_repeats")).withColumnRenamed("source", "used")
    total = chosen.agg(F.sum(F.col("tokens") * F.col("repeats")).alias("n")).first().n or 0
    reached_tokens = F.coalesce("reached_tokens", F.lit(0))
    return plan.join(reached, F.col("source") == F.col("used"), "left").select(
        "source", "weight", "max_repeats", "documents", F.col("available").alias("available_tokens"), "target_share", F.col("budget").alias("target_tokens"),
        F.coalesce("used_documents", F.lit(0)).alias("used_documents"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), reached_tokens.alias("reached_tokens"),
        (reached_tokens / F.lit(total) if total else F.lit(0.0)).alias("reached_share"),
        F.when(F.col("budget") > 0, F.col("target_share") * reached_tokens / F.col("budget")).otherwise(0.0).alias("share_of_wanted_total"),
    )
