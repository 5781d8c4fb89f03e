"""Thin a large table of texts down before it is shuffled to meet a list of ids."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikeflow.llm.common import map_batches

BITS = 1 << 23  # a broadcast of one megabyte, however many ids there are
_BUCKET = 1 << 15  # fixed value: bits of one bitmap of bitmap_construct_agg


def _bit(column: str):
    return F.pmod(F.xxhash64(F.col(column)), F.lit(BITS))


def probably_in(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` (columns ``doc_id``, ``text``) whose id may be among ``ids``, never fewer than are.

    A bitmap of fixed size: with more ids than it has bits it lets everything pass, which costs the shuffle that it
    would have saved and changes no result. The caller still joins on the id.
    """
    spark = docs.sparkSession
    bit = F.col("_bit") + 1
    rows = (
        ids.select(_bit(id_col).alias("_bit"))
        .groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        .collect()
    )
    bitmap = np.zeros(BITS // 8, np.uint8)
    for r in rows:
        at = (r.bucket - 1) * (_BUCKET // 8)
        bitmap[at : at + _BUCKET // 8] = np.frombuffer(bytes(r.bits), np.uint8)
    shared = spark.sparkContext.broadcast(bitmap.tobytes())

    def work(batches):
        bits = np.frombuffer(shared.value, np.uint8)
        for b in batches:
            at = np.asarray(b["_bit"], np.int64)
            hit = np.flatnonzero((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
            yield {"doc_id": [b["doc_id"][i] for i in hit], "text": [b["text"][i] for i in hit]}

    marked = docs.select("doc_id", "text", _bit("doc_id").alias("_bit"))
    return map_batches(marked, work, "doc_id bigint, text string")
