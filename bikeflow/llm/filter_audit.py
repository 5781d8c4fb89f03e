"""How filters interact: what each one removes in every order that they can be applied in.

A document is reduced to the mask of the filters that it fails, and documents are counted per part and mask. Orders are
numbered lexicographically (Lehmer rank). All orders that begin with the same filters have consecutive ranks, so the
orders in which a mask is removed at a given step are a few intervals of ranks: one for each choice of filters that it
passes before the first that it fails. Each mask adds its counts where an interval begins and takes them off where it
ends; prefix sums over the ranks then give what every order removes at every step. No order is ever played through.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikeflow.llm.common import WORDS
from bikeflow.plans.runtime import cut

MOST_FILTERS = 7  # 7! orders and a table of some ten thousand intervals


def removal_intervals(n: int) -> list[tuple[int, int, int, int]]:
    """``(mask, step, lo, hi)``: in orders of rank ``lo`` to ``hi`` (exclusive) of ``n`` filters a mask goes at ``step``.

    Neighbouring intervals of a mask and step are one. Masks are not 0; bit ``i`` is the ``i``-th filter.
    """
    out = []
    for mask in range(1, 1 << n):
        found: list[list[int]] = []

        def descend(left: list[int], base: int) -> None:
            step, width = n - len(left) + 1, factorial(len(left) - 1)
            for i, f in enumerate(left):
                lo = base + i * width
                if not mask >> f & 1:
                    descend(left[:i] + left[i + 1 :], lo)
                elif found and found[-1][0] == step and found[-1][2] == lo:
                    found[-1][2] = lo + width
                else:
                    found.append([step, lo, lo + width])

        descend(list(range(n)), 0)
        out += [(mask, *f) for f in found]
    return out


def interactions(masks: DataFrame, names: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """What every order of the filters ``names`` removes, per part.

    ``masks`` has ``part`` (string), ``mask`` (bit ``i`` set where the filter ``names[i]`` fails), ``n`` (documents) and
    the columns that are keys of ``measures``, further counts of them; rows of one part and mask add up. Filters are
    in the order that makes ``filter_order`` (their names in a row) lexicographic.

    Per part, order and step: ``kept``, ``removed``, ``redundant``, ``unique_fails``, the measures under the names that
    ``measures`` gives them, ``shapley``. A part without failures has rows of zeros; without rows there is no part.
    """
    n = len(names)
    if not 1 <= n <= MOST_FILTERS or list(names) != sorted(set(names)):
        raise ValueError(f"1 to {MOST_FILTERS} different filter names in ascending order")
    spark = masks.sparkSession
    counts = cut(
        masks.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[F.sum(m).alias(f"m{i}") for i, m in enumerate(measures)])
    )
    amounts = ["n", *[f"m{i}" for i in range(len(measures))]]

    ends = [(m, s, at, sign) for m, s, lo, hi in removal_intervals(n) for at, sign in ((lo, 1), (hi, -1)) if at < factorial(n)]
    intervals = spark.createDataFrame(ends, "mask int, step int, rank int, sign int")
    # Both tables that are broadcast here depend on the number of filters alone.
    changes = (
        counts.join(F.broadcast(intervals), "mask")
        .groupBy("part", "step", "rank")
        .agg(*[F.sum(F.col("sign") * F.col(a)).alias(a) for a in amounts])
    )
    orders = spark.createDataFrame(
        [(rank, step + 1, "".join(names[f] for f in order), order[step])
         for rank, order in enumerate(permutations(range(n))) for step in range(n)],
        "rank int, step int, filter_order string, filter int",
    )
    fails = F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(1 << i) > 0, F.col("n")).otherwise(0)) for i in range(n)])
    alone = F.array(*[F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(n)])
    spine = (
        counts.groupBy("part").agg(F.sum("n").alias("total"), fails.alias("fails"), alone.alias("alone"))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
        .withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(factorial(n) - 1))))
    )
    over_ranks = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    over_steps = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    summed = spine.join(changes, ["part", "step", "rank"], "left").select(
        "part", "step", "rank", "total", "fails", "alone",
        *[F.coalesce(F.sum(a).over(over_ranks), F.lit(0)).cast("bigint").alias(a) for a in amounts],
    )
    placed = summed.join(F.broadcast(orders), ["rank", "step"])
    return placed.select(
        "part", "filter_order", "step",
        (F.col("total") - F.sum("n").over(over_steps)).alias("kept"),
        F.col("n").alias("removed"),
        (F.get("fails", F.col("filter")) - F.col("n")).alias("redundant"),
        F.get("alone", F.col("filter")).alias("unique_fails"),
        *[F.col(f"m{i}").alias(name) for i, name in enumerate(measures.values())],
        F.sum("n").over(Window.partitionBy("part", "filter")).alias("shapley"),
    )


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text: A short, B repetitive, C many capitals, D symbols."""
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_masks(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """``doc_id``, ``part``, ``mask``, ``good``, ``toxic`` (0 or 1): one row per input row.

    The filters are those of ``text_failures`` and E, a text that a document with a smaller id has too, in any part. The
    row with the smallest id of a text never fails E, nor do further rows with that id. A null id is neither smaller nor larger
    than another. A null text is empty, a null part the empty string. ``good`` and ``toxic`` tell whether any row of
    ``labels`` for the id says 1; an id without labels, a null one and null labels count as 0. Other columns play no part.
    """
    plain = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    failing = text_failures(F.col("text")).values()
    bits = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failing)), F.lit(0))
    marks = cut(plain.select("doc_id", "part", bits.cast("int").alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")))
    # One row per text. Rows meet it by id and digest, so copies of one text are not gathered anywhere.
    firsts = marks.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    said = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (
        marks.join(firsts, ["doc_id", "digest"], "left").join(said, "doc_id", "left")
        .select(
            "doc_id", "part", (F.col("mask") + F.when(copy, 1 << 4).otherwise(0)).alias("mask"),
            F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"),
        )
    )


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """``interactions`` of the five filters of ``failure_masks`` over the documents of each part; an empty table gives no row."""
    masks = failure_masks(docs, labels, **columns).select("part", "mask", F.lit(1).cast("bigint").alias("n"), "good", "toxic")
    return interactions(masks, "ABCDE", {"good": "good_lost", "toxic": "toxic_lost"})
