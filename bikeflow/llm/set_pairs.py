"""Shingle sets of texts, and the exact check of pairs of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikeflow.llm.common import bounded_batches, map_arrow
from bikeflow.llm.hashing import Sequences, U, mix, word_hashes
from bikeflow.llm.prefilter import probably_in
from bikeflow.plans.components import components
from bikeflow.plans.runtime import cut

ONE_TASK_EDGES = 200_000    # links (3 MB) whose components one task finds at once


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a shorter text is one shingle, one without words none."""
    words = word_hashes(text.encode().lower())  # bytes.lower changes A-Z alone
    n = len(words)
    if not n:
        return words
    at = np.arange(max(n - size + 1, 1))
    found = np.sort(Sequences(words).of(at, np.minimum(at + size, n)))
    return found[np.r_[True, found[1:] != found[:-1]]]


def set_sums(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share, as two signed numbers."""
    with np.errstate(over="ignore"):
        a, b = (int(mix(hashes ^ U(x)).sum(dtype=U).view(np.int64)) for x in (0, 0xA0761D6478BD642F))
    return a, b


def shingle_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """``doc_id``, ``shingles`` (64-bit hashes, ascending, as bytes) of the documents in ``ids``."""

    def work(batches):
        for b in batches:
            yield {
                "doc_id": b.column("doc_id"),
                "shingles": [shingles(t.as_py(), size).tobytes() for t in b.column("text")],
            }

    wanted = probably_in(docs, ids).join(ids, "doc_id", "left_semi")
    return map_arrow(wanted, work, "doc_id bigint, shingles binary")


def linked(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Of the pairs ``a`` < ``b`` those with at least ``percent`` similarity, checked on the full sets; written already.

    Rows with both sets reach Python in batches of bounded bytes, so long texts do not add up.
    """
    with bounded_batches(docs.sparkSession):
        ids = cut(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
        sets = cut(shingle_sets(docs, ids, size))
        left = sets.select(F.col("doc_id").alias("_a"), F.col("shingles").alias("x"))
        right = sets.select(F.col("doc_id").alias("_b"), F.col("shingles").alias("y"))
        # Each side is an exchange of its own under an inner join, so AQE can split a much wanted document.
        both = pairs.join(left, F.col("a") == F.col("_a")).select("a", "b", "x").join(right, F.col("b") == F.col("_b"))

        def work(batches):
            for b in batches:
                good = np.zeros(b.num_rows, bool)
                for i, (x, y) in enumerate(zip(b.column("x"), b.column("y"), strict=True)):
                    x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                    small, large = (x, y) if len(x) <= len(y) else (y, x)
                    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    same = int((large[at] == small).sum())
                    good[i] = 100 * same >= percent * (len(x) + len(y) - same)
                yield {c: b.column(c).to_numpy()[good] for c in ("a", "b")}

        return cut(map_arrow(both.select("a", "b", "x", "y"), work, "a bigint, b bigint").distinct())


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """``node``, ``label`` after the components that ``links`` (``a``, ``b``, nodes) join have become one."""
    lower = label.select(F.col("node").alias("_x"), F.col("label").alias("la"))
    upper = label.select(F.col("node").alias("_y"), F.col("label").alias("lb"))
    bridges = links.join(lower, F.col("a") == F.col("_x")).join(upper, F.col("b") == F.col("_y")).select(
        F.col("la").alias("a"), F.col("lb").alias("b")
    )
    roots = label.select(F.col("label").alias("node")).distinct()
    merged = cut(components(roots, bridges, ONE_TASK_EDGES).select(F.col("node").alias("_r"), F.col("label").alias("root")))
    return cut(label.join(merged, F.col("label") == F.col("_r")).select("node", F.col("root").alias("label")))
