"""Exact deduplication against a persistent digest index.

The index is a Parquet table, bucketed and sorted by SHA-256, with one row per different text and
the document that stands for it. New rows are reduced to one row per digest before they
meet the index, so a text repeated by a third of all rows is one row there. A sort-merge
anti-join on the buckets finds the digests that are new, and these are appended.

Only DataFrame operations; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow.llm.common import unused
from bikeflow.plans.runtime import cut, parallelism

BUCKETS = 64    # at least, of a new index
SCHEMA = "text_sha256 string, keep_id bigint, first_batch string"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``row`` (a number that tells repeated ids apart) and ``text_sha256``.

    A null text counts as empty. Checkpointed: later joins read 80 bytes a row instead of the
    texts, and row numbers stay the same when a lost task runs again.
    """
    return cut(
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("text_sha256"),
        )
    )


def _groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the row with the largest id (null ids lose, then the largest row number)."""
    best = F.max(F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("i"), "row"))
    return rows.groupBy("text_sha256").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))


def open_index(spark: SparkSession, name: str, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """The index table, created when it is missing. ``path`` re-opens one that an earlier session wrote.

    It has as many buckets as a shuffle has partitions, unless ``buckets`` says otherwise. With fewer, a session that deals
    rows over more tasks writes a file per task and bucket.
    """
    if not spark.catalog.tableExists(name):
        buckets = buckets or max(BUCKETS, parallelism(spark))
        place = f"LOCATION '{path}'" if path else ""
        spark.sql(
            f"CREATE TABLE {name} ({SCHEMA}) USING parquet "
            f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {buckets} BUCKETS {place}"
        )
    return spark.table(name)


def append_new(spark: SparkSession, name: str, groups: DataFrame, batch: str) -> None:
    """Append the digests of ``groups`` that the index lacks, by a sort-merge anti-join on its buckets.

    Running a batch again appends nothing: its digests are there by then.
    """
    index = spark.table(name)
    buckets = int(
        {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}["Num Buckets"]
    )
    fresh = (
        groups.repartition(buckets, "text_sha256")
        .join(index.hint("merge").select("text_sha256"), "text_sha256", "left_anti")
        .select("text_sha256", F.col("best.i").alias("keep_id"), F.lit(batch).alias("first_batch"))
    )
    (
        cut(fresh)  # the table it reads is the one it is written to
        .repartition(buckets, "text_sha256")
        .write.mode("append").format("parquet").bucketBy(buckets, "text_sha256").sortBy("text_sha256")
        .saveAsTable(name)
    )
    spark.catalog.refreshTable(name)


def deduplicate(
    docs: DataFrame, index: str, batch: str, id_col: str = "doc_id", text_col: str = "text",
    path: str | None = None, buckets: int | None = None,
) -> DataFrame:
    """Decide every row of ``docs`` against the index and add its new texts to it.

    Returns ``doc_id``, ``keep_id``, ``group_size`` (rows of this batch with that text), ``kept``,
    ``text_sha256`` and ``row``, one row per input row. Within a batch the largest id of equal texts stays; a text
    that an earlier batch brought keeps that batch's row, so none of the new ones stays. Null text
    is the empty text. Among rows that repeat an id with one text, exactly one stays; a null id
    stays only if no other row has the text, with the smallest bigint as ``keep_id``. An
    empty input gives no rows and leaves the index as it is. Other columns play no part.
    """
    spark = docs.sparkSession
    rows = digests(docs, id_col, text_col)
    groups = cut(_groups(rows))
    open_index(spark, index, path, buckets)
    append_new(spark, index, groups, batch)
    held = spark.table(index).join(groups, "text_sha256").select(
        F.col("text_sha256").alias("_d"), "keep_id", "group_size",
        F.when(F.col("first_batch") == batch, F.col("best.row")).alias("_row"),
    )
    # Both sides come through plain exchanges, so a digest with very many rows can be split.
    return rows.join(held, rows["text_sha256"] == held["_d"]).select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("row") == F.col("_row"), F.lit(False)).alias("kept"), "text_sha256", "row",
    )


def deduplicate_in_batches(
    docs: DataFrame, index: str, parts: int = 2, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None
) -> DataFrame:
    """``deduplicate`` of the rows as they would come in ``parts`` batches, later ids first, against one growing index.

    Ranges of ids are found by approximate quantiles, which decide only where the batches end. The row that stays, and the
    size of a group, are those of all batches together: the first batch that has a text has its largest id. Null ids come last.
    The index is dropped once everything is decided; results are checkpointed.
    """
    spark = docs.sparkSession
    own = F.col(id_col).cast("bigint")
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx(own, F.lit(shares), F.lit(1000)).alias("q")).first()["q"] if shares else None
    ends = sorted(set(found or []))
    ranges = [F.coalesce(own <= ends[0], F.lit(True))] if ends else [F.lit(True)]
    ranges += [(own > low) & (own <= high) for low, high in zip(ends, ends[1:])] + ([own > ends[-1]] if ends else [])
    decided = None
    for i, within in enumerate(ranges[::-1]):
        batch = cut(deduplicate(docs.filter(within), index, f"{i}", id_col, text_col, buckets=buckets))
        decided = batch if decided is None else decided.unionByName(batch)
    spark.sql(f"DROP TABLE {index}")
    if len(ranges) == 1:
        return decided
    # A text's rows in each batch, once per batch: the largest id of a group there stands for it.
    sizes = cut(decided.groupBy(F.col("text_sha256").alias("_d")).agg(F.count(F.lit(1)).alias("_n")))
    return decided.join(sizes, F.col("text_sha256") == F.col("_d")).select(
        "doc_id", "keep_id", F.col("_n").alias("group_size"), "kept", "text_sha256"
    )


def keep_new(docs: DataFrame, index: str, batch: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``deduplicate`` keeps, with all their columns, whatever their names.

    Rows are matched by id and digest against the list of rows that go; of rows that repeat both, the one stays whose columns as
    JSON come last. An empty table stays empty.
    """
    own, digest, rows, kept = unused(docs, "_i", "_s", "_n", "_k")
    decided = deduplicate(docs, index, batch, id_col, text_col)
    dropped = cut(
        decided.groupBy(F.col("doc_id").alias(own), F.col("text_sha256").alias(f"{digest}_"))
        .agg(F.count(F.lit(1)).alias(rows), F.count_if("kept").alias(kept))
        .filter(F.col(rows) > F.col(kept))
    )
    named = docs.withColumn(digest, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    same = (named[digest] == F.col(f"{digest}_")) & named[id_col].cast("bigint").eqNullSafe(F.col(own))
    # Ids whose rows all go, or of which one repeated row stays; both lists hold dropped rows only.
    rest = named.join(dropped.select(own, f"{digest}_"), same, "left_anti").select(*docs.columns)
    partly = dropped.filter(F.col(kept) > 0).select(own, f"{digest}_")
    whole = F.struct(*[F.col(c) for c in docs.columns])
    again = (
        named.join(partly, same, "left_semi").groupBy(id_col, digest)
        .agg(F.max_by(whole, F.to_json(whole)).alias(rows)).select(f"{rows}.*")
    )
    return rest.unionByName(again)
