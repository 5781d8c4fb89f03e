"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = r"[^\x20\x09-\x0D]+"  # fixed value: what counts as a word

Batch = dict[str, list]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Each name with as many underscores before it as it takes to be no column of ``df``, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, so that no other column can clash; a null text becomes empty."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def n_words(text: Column | str) -> Column:
    """Words of a text; null has none."""
    found = F.regexp_count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORDS))
    return found.cast("bigint")


def words_of(text: str) -> list[bytes]:
    """The words as UTF-8. ``bytes.split`` cuts at just the six ASCII blanks of ``WORDS``."""
    return text.encode().split()


def map_batches(df: DataFrame, work: Callable[[Iterator[Batch]], Iterator[Batch]], schema: str) -> DataFrame:
    """Run ``work`` over the column batches of each task; rows never meet outside their batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(b.to_pydict() for b in batches if b.num_rows):
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(run, schema)


@contextmanager
def bounded_batches(spark: SparkSession, size: str = "4MB"):
    """Batches that Spark hands to Python hold ``size`` bytes at most, or one row, for jobs that run inside.

    The default counts rows, whatever their length. What is lazy and runs after the block has the session's own bound.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """Like ``map_batches``, but ``work`` reads the Arrow batches themselves and yields arrays by column name."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(b for b in batches if b.num_rows):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def row_wise(df: DataFrame, make: Callable[..., tuple], inputs: list[str], schema: str) -> DataFrame:
    """One output row from the ``inputs`` of each input row; ``make`` is called once per row in a task."""
    names = [part.strip().split()[0] for part in schema.split(",")]

    def work(batches: Iterator[Batch]) -> Iterator[Batch]:
        for b in batches:
            rows = [make(*r) for r in zip(*[b[c] for c in inputs], strict=True)]
            yield dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))

    return map_batches(df.select(*inputs), work, schema)
