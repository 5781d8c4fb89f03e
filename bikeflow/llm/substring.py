"""Remove passages that repeat across documents, by seed and extend.

Seeds are winnowed anchors: of the hashes of ``gram`` consecutive words in each window of ``length`` words the
smallest is kept, the leftmost of ties. Equal windows keep the same anchor at the same place, so two documents that
share a window share its anchor. An anchor stands for a run of consecutive windows; the words of that
run are as far as a match is extended from it to the left and to the right, and the runs of a
document meet without gaps. Occurrences of an anchor are compared in classes, not in pairs:

* occurrences whose whole run is the same are one class. All but those in the smallest document of it are matched
  over the full run;
* where an anchor has several classes, the occurrences in the smallest document of each are extended window by window,
  and a window is matched where a smaller document has it.

Adjoining matches make up the maximal repeats; their words are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bikeflow.llm.common import map_batches, texts, words_of
from bikeflow.llm.hashing import Sequences, U, word_hashes
from bikeflow.llm.prefilter import probably_in
from bikeflow.plans.runtime import cut

SHIFT = 8  # runs are packed as start << SHIFT | windows - 1; a run has at most length - gram + 1 windows


def anchors(text: str, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, hash of the run's words and packed run, for each run of windows of a text."""
    words = word_hashes(text.encode())
    n = len(words) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    seq = Sequences(words)
    at = np.arange(len(words) - gram + 1)
    grams = seq.of(at, at + gram)
    best = np.lib.stride_tricks.sliding_window_view(grams, length - gram + 1).argmin(axis=1) + np.arange(n)
    first = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
    last = np.r_[first[1:], n] - 1
    place = best[first]
    with np.errstate(over="ignore"):
        span = seq.of(first, last + length) + (place - first).astype(U)  # and where the anchor is in it
    return grams[place].view(np.int64), span.view(np.int64), (first << SHIFT) | (last - first)


def _seeds(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def work(batches):
        for b in batches:
            for lo in range(0, len(b["text"]), 512):
                parts = [anchors(t, length, gram) for t in b["text"][lo : lo + 512]]
                ids = np.repeat(np.asarray(b["doc_id"][lo : lo + 512], np.int64), [len(p[0]) for p in parts])
                anchor, span, run = (np.concatenate(x) for x in zip(*parts, strict=True))
                digests = np.repeat(np.asarray(b["digest"][lo : lo + 512], np.int64), [len(p[0]) for p in parts])
                yield {"anchor": anchor, "span": span, "doc_id": ids, "digest": digests, "run": run}

    return map_batches(docs, work, "anchor bigint, span bigint, doc_id bigint, digest bigint, run bigint")


def _with_digest(docs: DataFrame) -> DataFrame:
    """Rows that repeat an id may have other texts: ``digest`` tells them apart."""
    return docs.withColumn("digest", F.xxhash64("text"))


def _same_text() -> Column:
    return (F.col("doc_id") == F.col("_i")) & (F.col("digest") == F.col("_d"))


def _extended(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """``window``, ``doc_id``, ``digest``, ``start`` of every window of the ``runs``, from the texts."""
    packed = runs.groupBy(F.col("doc_id").alias("_i"), F.col("digest").alias("_d")).agg(F.collect_list("run").alias("runs"))
    joined = _with_digest(probably_in(docs, packed, "_i")).join(packed, _same_text())

    def work(batches):
        for b in batches:
            for doc, digest, text, packed_runs in zip(b["doc_id"], b["digest"], b["text"], b["runs"], strict=True):
                run = np.asarray(packed_runs, np.int64)
                first, size = run >> SHIFT, (run & ((1 << SHIFT) - 1)) + 1
                start = np.repeat(first - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
                window = Sequences(word_hashes(text.encode())).of(start, start + length)
                own = {"doc_id": np.full(len(start), doc), "digest": np.full(len(start), digest)}
                yield {"window": window.view(np.int64), **own, "start": start}

    picked = joined.select("doc_id", "digest", "text", "runs")
    return map_batches(picked, work, "window bigint, doc_id bigint, digest bigint, start bigint")


def matches(docs: DataFrame, length: int = 50, gram: int = 20) -> DataFrame:
    """``doc_id``, ``digest``, ``run``: packed runs of windows that a document with a smaller id has as well."""
    if not 0 <= length - gram < 1 << SHIFT:
        raise ValueError("gram must be at most length, and their difference below 256")
    seeds = cut(_seeds(_with_digest(docs), length, gram))
    # Groups are checkpointed before rows are joined with them: the join then has a plain exchange on either side, and
    # AQE can split an anchor that holds a large part of the rows.
    often = cut(seeds.groupBy(F.hash("anchor").alias("_a")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_a"))
    shared = cut(seeds.join(often, F.hash("anchor") == F.col("_a")).drop("_a"))
    # One class per anchor and run of words, with the smallest document that has it.
    classes = cut(
        shared.groupBy(F.col("anchor").alias("_a"), F.col("span").alias("_s")).agg(F.min("doc_id").alias("low"))
    )
    members = cut(
        shared.join(classes, (F.col("anchor") == F.col("_a")) & (F.col("span") == F.col("_s")))
        .select("doc_id", "digest", "run", "low", "anchor")
    )
    whole = members.filter("doc_id > low")
    several = cut(
        classes.groupBy(F.col("_a").alias("_m"))
        .agg(F.min("_s").alias("a"), F.max("_s").alias("b"), F.min("low").alias("least"), F.max("low").alias("most"))
        .filter("a <> b and least <> most").select("_m")
    )
    first_of = members.filter("doc_id = low").join(several, F.col("anchor") == F.col("_m"))
    windows = cut(_extended(docs, first_of.select("doc_id", "digest", "run").distinct(), length))
    lowest = cut(
        windows.groupBy(F.col("window").alias("_w")).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("top"))
        .filter("low <> top")
    )
    found = cut(
        windows.join(lowest, (F.col("window") == F.col("_w")) & (F.col("doc_id") > F.col("low")))
        .select("doc_id", "digest", "start").distinct()
    )
    # The other members of a class are in larger documents and matched over the whole run already.
    single = found.select("doc_id", "digest", F.shiftleft("start", SHIFT).alias("run"))
    return whole.select("doc_id", "digest", "run").unionByName(single)


def covered(runs: list[int], n_words: int, length: int) -> np.ndarray:
    """Which of a text's words the matches cover: the union of the maximal repeats."""
    run = np.asarray(runs, np.int64)
    first, end = run >> SHIFT, (run >> SHIFT) + (run & ((1 << SHIFT) - 1)) + length
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, np.minimum(first, n_words), 1)
    np.add.at(edge, np.minimum(end, n_words), -1)
    return np.cumsum(edge[:n_words]) > 0


def remove_repeats(
    docs: DataFrame, length: int = 50, gram: int = 20, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and with ``with_text`` the ``kept`` words, joined by one space.

    A word goes if it lies in a window of ``length`` words that also starts in a document with a smaller id.
    One row per input row. A null or empty text has no words. Rows that repeat an id are one document as far as
    "smaller" goes: they do not remove each other's words, but each loses what a
    smaller document has. A null id counts as the smallest bigint. Other columns play no part.
    """
    plain = texts(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"), "text")
    found = matches(plain, length, gram).groupBy(F.col("doc_id").alias("_i"), F.col("digest").alias("_d"))
    runs = cut(found.agg(F.collect_list("run").alias("runs")))

    def keep(with_runs):
        def work(batches):
            for b in batches:
                out = {c: [] for c in ("doc_id", "n_words", "n_removed", "kept_sha256", "kept")}
                out["digest"] = b["digest"]
                for i, (doc, text) in enumerate(zip(b["doc_id"], b["text"], strict=True)):
                    words = words_of(text)
                    kept = words
                    if with_runs:
                        gone = covered(b["runs"][i], len(words), length)
                        kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                    joined = b" ".join(kept)
                    out["doc_id"].append(doc)
                    out["n_words"].append(len(words))
                    out["n_removed"].append(len(words) - len(kept))
                    out["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
                    out["kept"].append(joined.decode() if with_text else None)
                yield out

        return work

    schema = "doc_id bigint, digest bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"
    # Only texts with a match are shuffled to meet their runs; the others are done where they are read.
    near = _with_digest(probably_in(plain, runs, "_i"))
    touched = map_batches(near.join(runs, _same_text()).select("doc_id", "digest", "text", "runs"), keep(True), schema)
    rest = map_batches(_with_digest(plain), keep(False), schema).join(runs.select("_i", "_d"), _same_text(), "left_anti")
    both = touched.unionByName(rest).drop("digest")
    return both if with_text else both.drop("kept")
