"""Mix sources to target weights by Pareto order sampling.

Sizes are words. A source's target is its weight's share of the budget, stopped at ``max_copies``
times its size; what is cut off is shared anew. Each document is first taken as often as its source's
target holds the source whole. The rest is a sample without replacement: a document of size z has the
inclusion probability p = min(1, c * z ** tilt) with c such that the expected words are the
rest, and documents are ranked by the odds of a uniform number over the odds of p. The first ones whose words come
nearest the rest are taken, so the size of the sample is fixed in words, not only in expectation.
Uniform numbers are hashes of the id: every run and every repeated task draws the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikeflow.llm.common import n_words, unused
from bikeflow.plans.runtime import cut
from bikeflow.plans.segments import row_numbers


def uniform(id_col: str, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(2.0**52)


def targets(by_source: DataFrame, weights: Sequence[int], share: float, max_copies: float) -> DataFrame:
    """``source``, ``source_size``, ``target`` from the sizes of all sources.

    Weights are dealt out to the sources in code point order, null last, over and over. Sources whose
    share is above the stop get the stop, the others share the rest by weight, until none is above. Each
    round brings one row to the driver; there are as many as it takes.
    """
    ordered = by_source.withColumn("_none", F.col("source").isNull())
    numbered = row_numbers(ordered, ["_none", "source"], "_at")
    deal = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("_at", F.lit(len(weights))) + 1).cast("int"))
    weighed = cut(
        numbered.withColumn("_at", F.col("_at") - 1)
        .withColumn("_w", deal.cast("bigint"))
        .withColumn("_cap", F.col("source_size") * F.lit(float(max_copies)))
        .select("source", "source_size", "_w", "_cap")
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    budget, level, stopped = share * total, 0.0, -1
    while True:
        above = F.col("_cap") < F.col("_w") * F.lit(level)
        row = weighed.agg(
            F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)).alias("size"),
            F.coalesce(F.sum(F.when(~above, F.col("_w"))), F.lit(0)).alias("w"),
        ).first()
        if row.n == stopped or not row.w:
            break
        stopped, level = row.n, (budget - max_copies * row["size"]) / row.w
    final = F.least(F.col("_cap"), F.col("_w") * F.lit(level)) if row.w else F.col("_cap")
    return weighed.select("source", "source_size", final.alias("target"))


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, max_copies: float = 2.0,
    tilt: float = 0.5, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``; a row per document.

    A null or empty text has size 0 and takes nothing (``copies`` 0 unless its source is taken whole). A null source is a source of its own,
    last in order. Rows that repeat an id draw the same number and are ranked by size. With no words at all every target is 0.
    ``max_copies`` must be a whole number of copies at least 1; no document is taken more often.
    """
    if max_copies < 1 or max_copies != int(max_copies):
        raise ValueError("max_copies must be a whole number of at least 1")
    sized = cut(
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            n_words(F.col(text_col)).alias("size"),
        )
    )
    by_size = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    by_source = cut(by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")))
    goal = targets(by_source, weights, share, max_copies)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goal = cut(
        goal.withColumn("whole", whole.cast("bigint")).withColumn(
            "rest", F.col("target") - F.col("whole") * F.col("source_size")
        )
    )

    # One row per source and size: how likely a document of that size is. The largest sizes that would
    # have p >= 1 are taken for sure, the factor for the others follows from what they leave.
    weight = F.pow(F.col("size").cast("double"), F.lit(float(tilt)))
    if tilt == 0.5:
        weight = F.sqrt(F.col("size").cast("double"))
    upto = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everyone = Window.partitionBy("source")
    words, pull = F.col("n") * F.col("size"), F.col("n") * F.col("size") * F.col("w")
    odds = (
        by_size.join(
            goal.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
        ).drop("_source")
        .withColumn("w", weight)
        .withColumn("larger", F.coalesce(F.sum(words).over(upto), F.lit(0)))
        .withColumn("sure", (F.col("rest") - F.col("larger")) * F.col("w") >= F.sum(pull).over(below))
        .withColumn("sure", F.col("sure") & (F.col("rest") > 0) & (F.col("size") > 0))
        .withColumn("left", F.col("rest") - F.coalesce(F.sum(F.when(F.col("sure"), words)).over(everyone), F.lit(0)))
        .withColumn("pulls", F.sum(F.when(~F.col("sure"), pull)).over(everyone))
        .withColumn("p", F.when(F.col("sure"), F.lit(1.0)).when(F.col("pulls") > 0, F.col("left") / F.col("pulls") * F.col("w")))
        .select(F.col("source").alias("_source"), F.col("size").alias("_size"), "source_size", "target", "whole", "rest", "p")
    )
    u = uniform("doc_id", seed)
    rank = F.when((F.col("p") >= 1) | (u == 0), F.lit(0.0)).when(
        F.col("p") > 0, (u * (F.lit(1.0) - F.col("p"))) / ((F.lit(1.0) - u) * F.col("p"))
    )
    # Sources differ in size, so AQE may split the hot ones: nothing is grouped right after this join.
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    ranked = cut(
        sized.join(odds, same)
        .select("doc_id", "source", "size", "source_size", "target", "whole", "rest", rank.alias("rank"))
    )

    # Where the rest ends: sums per slice of the ranking first, single documents only in the slice of the cut.
    n_slices = int(ranked.count() ** 0.5) + 1
    ranked = ranked.withColumn("slice", F.floor(F.col("rank") / (F.col("rank") + 1) * F.lit(n_slices)))
    sums = ranked.filter("rank is not null").groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest")))
        .groupBy("source").agg(F.min(F.struct("slice", "before")).alias("end"))
        .select(F.col("source").alias("_s"), F.col("end.slice").alias("end_slice"), F.col("end.before").alias("end_before"))
    )
    placed = ranked.join(ends, ranked["source"].eqNullSafe(ends["_s"]), "left").drop("_s")
    at_end = F.col("slice") == F.col("end_slice")
    in_order = (
        Window.partitionBy("source", "slice").orderBy("rank", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    cut_slice = (
        placed.filter(at_end)
        .withColumn("upto", F.col("end_before") + F.sum("size").over(in_order))
        .withColumn("start", F.col("upto") - F.col("size"))
        .withColumn(
            "extra",
            (F.col("upto") <= F.col("rest"))
            | ((F.col("start") < F.col("rest")) & (F.col("upto") - F.col("rest") < F.col("rest") - F.col("start"))),
        )
        .drop("upto", "start")
    )
    others = placed.filter(~F.coalesce(at_end, F.lit(False))).withColumn(
        "extra",
        # Without a slice of the cut the ranked words do not reach the rest, and all are taken.
        F.col("rank").isNotNull() & (F.col("end_slice").isNull() | (F.col("slice") < F.col("end_slice"))) & (F.col("rest") > 0),
    )
    copies = F.col("whole") + F.col("extra").cast("bigint")
    return cut_slice.unionByName(others).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def repeat_copies(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with each row as often as ``mixed`` takes its document; a document it does not take goes.

    The choice of a document with a null id, or of one whose id has several rows, goes to all rows of that id. All columns
    stay, whatever their names. An empty table stays empty.
    """
    own, times, nth = unused(docs, "_i", "_n", "_c")
    often = mixed.groupBy(F.col("doc_id").alias(own)).agg(F.max("copies").alias(times)).filter(F.col(times) > 0)
    joined = docs.join(often, docs[id_col].cast("bigint").eqNullSafe(often[own]))
    return joined.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(*docs.columns)
