"""Exact join of texts by the Jaccard similarity of their word n-grams, by PartEnum signatures.

Similar sets differ in few elements. The domain of 64-bit hashes is cut into groups of three parts, with so many groups that
the differing elements of a linked pair cannot put two into every group. In a group with one at most, two of its three parts
are equal: the signatures of a set are the projections on every two parts of every group, and a linked pair shares one. How
many groups that takes depends on the size, so sizes are cut into bands in which and between neighbours of which links lie;
a set has signatures for its own band and for the next one, where it may be the smaller partner.

An empty projection would be shared by strangers. A band has some more groups than it needs, so a linked pair agrees in
several; a set lists its empty projections only where it has so many that those groups might all be among them.

1. Texts with equal sets are one class; its smallest id goes on.
2. Every member of a bucket (a shared signature) meets the member that shares most. Candidates are refuted by parity bitmaps,
   whose differing bits never exceed the differing elements, and what is left is checked on the full sets.
3. All who met one hub are a family. Families in which several components are left get further hubs, and at last their
   members meet in blocks: every pair of different components is refuted by its bitmaps or checked.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import lru_cache
from math import exp, lgamma, log, log1p

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bikeflow.llm.common import bounded_batches, map_arrow, texts
from bikeflow.llm.hashing import BASE, U, mix
from bikeflow.llm.prefilter import probably_in
from bikeflow.llm.set_pairs import ONE_TASK_EDGES, linked, merged, set_sums, shingles
from bikeflow.plans.components import components
from bikeflow.plans.runtime import cut

PARTS = 3              # of a group, of which two make a signature
RARE = 1e-4            # wanted probability that a set must list empty projections
HUB_ROUNDS = 1         # rounds with one more hub per family before the rest meets in blocks
BLOCK = 512            # members of a family that meet in one piece of work
LEAST_BITS = 256


def least_size(percent: int) -> int:
    """Smaller sets link with equal ones alone."""
    return -(-percent // (100 - percent))


@lru_cache
def _bands(percent: int, upto: int) -> tuple[int, ...]:
    """Where the bands of sizes begin; sizes that can link lie in one band or in neighbours."""
    lows = [least_size(percent)]
    while lows[-1] <= upto:
        lows.append(lows[-1] * 100 // percent + 1)
    return tuple(lows)


def differing(total: int, percent: int) -> int:
    """In how many elements two sets of ``total`` elements together may differ and be linked."""
    return total * (100 - percent) // (100 + percent)


@lru_cache
def layout(low: int, percent: int) -> tuple[np.ndarray, int]:
    """Where the parts of the band that begins at ``low`` start, and in how many groups a linked pair agrees at least."""
    high = low * 100 // percent
    needed = differing(2 * high, percent) // 2 + 1
    smallest = max(low * percent // 100, least_size(percent))

    def lists_empty(extra: int) -> float:
        groups = needed + extra
        empty = PARTS * (1 - (PARTS - 1) / (PARTS * groups)) ** smallest
        if empty >= 1:
            return 1.0
        some = (lgamma(groups + 1) - lgamma(i + 1) - lgamma(groups - i + 1) + i * log(empty) + (groups - i) * log1p(-empty)
                for i in range(extra + 1))
        return max(1 - sum(map(exp, some)), 0.0)

    tries = range(max(needed // 4, 2) + 1)
    extra = next((x for x in tries if lists_empty(x) < RARE), None)
    extra = min(tries, key=lists_empty) if extra is None else extra
    parts = PARTS * (needed + extra)
    return np.array([(p << 64) // parts for p in range(parts)], U), extra + 1


def signatures(hashes: np.ndarray, percent: int) -> np.ndarray:
    """The signatures of a sorted set of 64-bit hashes; none for a set that links with equal ones alone."""
    n = len(hashes)
    if n < least_size(percent):
        return np.zeros(0, np.int64)
    lows = _bands(percent, 1 << max(n.bit_length(), 12))
    band = bisect_right(lows, n) - 1
    out = []
    with np.errstate(over="ignore"):
        upto = np.r_[U(0), np.cumsum(mix(hashes))]
        for low in lows[band : band + 2]:
            edges, agreed = layout(low, percent)
            at = np.r_[np.searchsorted(hashes, edges), n]
            sums, counts = (np.diff(v[at] if v is upto else at).reshape(-1, PARTS) for v in (upto, at))
            # A signature leaves one part of its group out.
            value = sums.sum(1, dtype=U)[:, None] - sums
            empty = counts.sum(1)[:, None] == counts
            place = np.arange(value.size, dtype=U).reshape(value.shape) + U(low) * U(BASE)
            found = mix(value + mix(place))
            out.append(found.ravel() if empty.any(1).sum() >= agreed else found[~empty])
    return np.concatenate(out).view(np.int64)


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """The parity bitmap of a set, in 64-bit words; it has four bits an element or more, a power of two of them."""
    bits = max(LEAST_BITS, 1 << (4 * len(hashes) - 1).bit_length()) if len(hashes) else LEAST_BITS
    with np.errstate(over="ignore"):
        at = mix(hashes + U(BASE)) & U(bits - 1)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).view(U)


def fold(words: np.ndarray, length: int) -> np.ndarray:
    """A bitmap as it would be with ``length`` words, fewer than it has."""
    return np.bitwise_xor.reduce(words.reshape(-1, length), axis=0)


def may_link(n: int, m: int, a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether sizes and bitmaps leave a pair open; a linked pair always is."""
    if 100 * min(n, m) < percent * max(n, m):
        return False
    length = min(len(a), len(b))
    return int(np.bitwise_count(fold(a, length) ^ fold(b, length)).sum()) <= differing(n + m, percent)


def _marks(docs: DataFrame, size: int) -> DataFrame:
    def work(batches):
        for b in batches:
            sets = [shingles(t.as_py(), size) for t in b.column("text")]
            sums = np.array([set_sums(s) for s in sets], np.int64).reshape(-1, 2)
            yield {
                "doc_id": b.column("doc_id"), "n": [len(s) for s in sets], "set_a": sums[:, 0], "set_b": sums[:, 1],
                "bits": [bitmap(s).tobytes() for s in sets],
            }

    return map_arrow(docs, work, "doc_id bigint, n bigint, set_a bigint, set_b bigint, bits binary")


def _signed(docs: DataFrame, size: int, percent: int) -> DataFrame:
    def work(batches):
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            found = [signatures(shingles(t.as_py(), size), percent) for t in b.column("text")]
            yield {"sig": np.concatenate(found), "doc_id": np.repeat(ids, [len(f) for f in found])}

    return map_arrow(docs, work, "sig bigint, doc_id bigint")


def _open_pairs(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` that sizes and bitmaps leave open."""

    def side(c: str) -> DataFrame:
        return marks.select(F.col("doc_id").alias(f"_{c}"), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"s{c}"))

    both = pairs.join(side("a"), F.col("a") == F.col("_a")).select("a", "b", "na", "sa")
    both = both.join(side("b"), F.col("b") == F.col("_b")).filter(
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    )

    def work(batches):
        for b in batches:
            na, nb = b.column("na").to_pylist(), b.column("nb").to_pylist()
            sides = zip(na, nb, b.column("sa"), b.column("sb"), strict=True)
            good = np.array(
                [may_link(n, m, np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U), percent) for n, m, x, y in sides]
            )
            yield {c: b.column(c).to_numpy()[good] for c in ("a", "b")}

    return map_arrow(both.select("a", "b", "na", "nb", "sa", "sb"), work, "a bigint, b bigint")


def _block_pairs(family: DataFrame, percent: int) -> DataFrame:
    """Pairs of one family (``hub``) but of different components that sizes and bitmaps leave open."""
    sizes = cut(family.groupBy(F.col("hub").alias("_h")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_k")))
    placed = (
        family.join(sizes, F.col("hub") == F.col("_h"))
        .withColumn("mine", F.pmod(F.xxhash64("doc_id"), "_k").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        .withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other"))
    )

    def pairs(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        maps = [np.frombuffer(b, U) for b in group["bits"]]
        label, n, doc, mine = (group[c].to_numpy() for c in ("label", "n", "doc_id", "mine"))
        length = np.array([len(m) for m in maps])
        groups = {int(size): np.flatnonzero((length == size) & (mine == key[2])) for size in np.unique(length)}
        folded: dict[tuple[int, int], np.ndarray] = {}
        out = [np.zeros((0, 2), np.int64)]
        for i in np.flatnonzero(mine == key[1]):
            for size, at in groups.items():
                fit = (label[at] != label[i]) & (100 * np.minimum(n[at], n[i]) >= percent * np.maximum(n[at], n[i]))
                fit &= (key[1] != key[2]) | (at > i)  # a block that meets itself sees each pair once
                if not fit.any():
                    continue
                words = min(size, len(maps[i]))
                if (size, words) not in folded:
                    folded[size, words] = np.stack([fold(maps[j], words) for j in at])
                differ = np.bitwise_count(folded[size, words][fit] ^ fold(maps[i], words)).sum(1)
                j = at[fit]
                j = j[differ <= (n[j] + n[i]) * (100 - percent) // (100 + percent)]
                out.append(np.stack([np.minimum(doc[j], doc[i]), np.maximum(doc[j], doc[i])], 1))
        return pd.DataFrame(np.concatenate(out), columns=["a", "b"])

    fields = ["hub", "lo", "hi", "mine", "doc_id", "label", "n", "bits"]
    return placed.select(*fields).groupBy("hub", "lo", "hi").applyInPandas(pairs, "a bigint, b bigint").distinct()


def _undecided(family: DataFrame, label: DataFrame) -> DataFrame:
    """``hub``, ``doc_id``, ``deg``, ``label``: the families whose members are not all in one component."""
    named = cut(family.join(label, F.col("doc_id") == F.col("node")).select("hub", "doc_id", "deg", "label"))
    split = (
        named.groupBy(F.col("hub").alias("_h")).agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).filter("_lo <> _hi")
    )
    return cut(named.join(cut(split.select("_h")), F.col("hub") == F.col("_h"), "left_semi"))


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def join_components(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``: one row per input row.

    Documents are linked if their sets of ``size``-word shingles have at least ``percent`` (50 to 99) in common, exactly;
    ``component_id`` is the smallest id reached over links. A null or empty text and one without words has an empty set and
    no links. A text of fewer words is one shingle. Rows that repeat an id are one document, linked where one of its texts
    is. A null id counts as the smallest bigint. Ties do not matter: every link is found. Other columns play no part; an
    empty table gives no row.
    """
    if not 50 <= percent <= 99:
        raise ValueError("percent must be 50 to 99")
    spark = docs.sparkSession
    plain = texts(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"), "text")
    with bounded_batches(spark):
        marks = cut(_marks(plain, size))

    # Step 1. Groups that rows are joined with are checkpointed, so that AQE can split one that holds a large part of them.
    small = marks.filter("n > 0").select("doc_id", "n", "set_a", "set_b")
    classes = cut(small.groupBy(*[F.col(c).alias("_" + c) for c in ("n", "set_a", "set_b")]).agg(F.min("doc_id").alias("rep")))
    same_set = (F.col("n") == F.col("_n")) & (F.col("set_a") == F.col("_set_a")) & (F.col("set_b") == F.col("_set_b"))
    class_of = cut(small.join(classes, same_set).select("doc_id", "rep"))
    nodes = cut(classes.select(F.col("rep").alias("node")).distinct())
    several = class_of.groupBy(F.col("doc_id").alias("_i")).agg(F.min("rep").alias("a"), F.max("rep").alias("m")).filter("a <> m")
    ties = several.join(class_of, F.col("doc_id") == F.col("_i")).select("a", F.col("rep").alias("b")).filter("a <> b")

    # Step 2.
    signing = cut(classes.filter(F.col("_n") >= least_size(percent)).select(F.col("rep").alias("doc_id")).distinct())
    by_sig = Window.partitionBy("sig")
    with bounded_batches(spark):
        signed = _signed(probably_in(plain, signing).join(signing, "doc_id", "left_semi"), size, percent).select(
            "doc_id", F.min("doc_id").over(by_sig).alias("lo"), F.max("doc_id").over(by_sig).alias("hi"),
            F.count(F.lit(1)).over(by_sig).alias("members"), F.bit_xor(F.xxhash64("doc_id")).over(by_sig).alias("all"),
        )
        # Two alike share most of their buckets, with the same members: one bucket stands for all that have the same.
        bucket = F.xxhash64("lo", "hi", "members", "all").alias("bucket")
        shared = cut(signed.filter("lo <> hi").groupBy(bucket, "doc_id", "members").agg(F.count(F.lit(1)).alias("times")))
    degree = shared.groupBy(F.col("doc_id").alias("_i")).agg(F.sum(F.col("members") * F.col("times")).alias("deg"))
    placed = cut(shared.join(degree, F.col("doc_id") == F.col("_i")).select("bucket", "doc_id", "deg"))
    hubs = placed.groupBy(F.col("bucket").alias("_s")).agg(F.max(F.struct("deg", "doc_id"))["doc_id"].alias("hub"))
    family = cut(
        placed.join(hubs, F.col("bucket") == F.col("_s")).filter("hub <> doc_id").select("hub", "doc_id", "deg").distinct()
    )
    meeting = cut(family.select("doc_id").union(family.select("hub")).distinct())
    active = cut(marks.select("doc_id", "n", "bits").join(meeting.toDF("_i"), F.col("doc_id") == F.col("_i"), "left_semi"))
    with bounded_batches(spark):
        tested = cut(_open_pairs(family.select(*_pair("hub", "doc_id")).distinct(), active, percent))
    label = cut(components(nodes, linked(plain, tested, size, percent).unionByName(ties), ONE_TASK_EDGES))

    # Step 3. The hub has met its family; the others go on without it.
    rest = _undecided(family, label)
    for _ in range(HUB_ROUNDS):
        if rest.isEmpty():
            break
        of_hub = label.select(F.col("node").alias("_h"), F.col("label").alias("_l"))
        outside = rest.join(of_hub, F.col("hub") == F.col("_h")).withColumn("_out", F.col("label") != F.col("_l"))
        heads = cut(
            outside.groupBy(F.col("hub").alias("_h"))
            .agg(F.max(F.struct("_out", "deg", "doc_id", "label")).alias("_m"))
            .select("_h", F.col("_m.doc_id").alias("head"), F.col("_m.label").alias("head_label"))
        )
        met = cut(rest.join(heads, F.col("hub") == F.col("_h")))
        fresh = met.filter("label <> head_label").select(*_pair("head", "doc_id")).distinct()
        with bounded_batches(spark):
            found = cut(_open_pairs(fresh.join(tested, ["a", "b"], "left_anti"), active, percent))
        tested = cut(tested.unionByName(found))
        label = merged(label, linked(plain, found, size, percent))
        rest = _undecided(met.filter("doc_id <> head").select("hub", "doc_id", "deg"), label)
    if not rest.isEmpty():
        rows = rest.join(active.withColumnRenamed("doc_id", "_i"), F.col("doc_id") == F.col("_i"))
        found = cut(_block_pairs(rows.select("hub", "doc_id", "label", "n", "bits"), percent).join(tested, ["a", "b"], "left_anti"))
        label = merged(label, linked(plain, found, size, percent))
    component = (
        class_of.join(label, F.col("rep") == F.col("node"))
        .groupBy(F.col("doc_id").alias("_i")).agg(F.min("label").alias("root"))
    )
    return (
        marks.select("doc_id", F.col("n").alias("n_shingles"))
        .join(component, F.col("doc_id") == F.col("_i"), "left")
        .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
    )
