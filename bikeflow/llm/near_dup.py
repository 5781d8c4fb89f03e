"""Near-duplicate groups: banded MinHash, odd sketches for the candidates, exact checks on the full sets.

1. Every text becomes its set of word shingles. A MinHash signature (one sample per slice of the hash range, empty
   slices borrowing from others) gives the band keys. The smallest hashes of the set, a second kind of MinHash samples, are folded into an odd
   sketch: each flips one bit of a bitmap, so two bitmaps differ in no more bits than the samples of the two sets
   differ in elements. Texts with equal sets are one class from here on; only its smallest id goes on.
2. In each bucket of a band all members are compared with the smallest one. Pairs that the sketches leave open are checked
   on the full sets, and components are formed.
3. In buckets that still hold several components the members of different ones are compared, in blocks of bounded
   size; again sketches first, then full sets. A pair is taken in the first bucket that it shares only. The first rounds take
   no more pairs of a block than would join its components, so a family of many costs pairs in proportion to its members; blocks
   that left pairs out and stay apart are compared in full. After this every pair that shares a bucket is in one component or refuted.

Bands of 4 samples, 32 of them, miss a pair of similarity 0.8 with a probability below 1e-7. The limit on differing bits
follows from the two sizes; for sets that the sketch holds whole it refutes no pair wrongly, for larger ones it leaves
six standard deviations.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bikeflow.llm.common import bounded_batches, map_arrow, texts, unused
from bikeflow.llm.hashing import U, mix
from bikeflow.llm.set_pairs import ONE_TASK_EDGES, linked, merged, set_sums, shingles
from bikeflow.plans.components import components
from bikeflow.plans.runtime import cut

ROWS, BANDS = 4, 32
SAMPLES = ROWS * BANDS
BITS = 2048         # of a sketch
FOLDED = 512        # smallest hashes that go into it
BLOCK = 1024        # members of a bucket that meet in one piece of work
TREE_ROUNDS = 2     # rounds that take no more pairs of a block than it has components

_EDGES = np.arange(SAMPLES, dtype=U) << U(64 - 7)
# For each slice, in which order it looks for one to borrow from: itself first, then all others by hash.
_LENDERS = np.argsort(
    mix(np.arange(SAMPLES * SAMPLES, dtype=U) + U(1)).reshape(SAMPLES, SAMPLES) >> U(1)
    | (~np.eye(SAMPLES, dtype=bool)).astype(U) << U(63), axis=1,
)
_EACH = np.arange(SAMPLES)


def samples(hashes: np.ndarray) -> np.ndarray:
    """The smallest hash in each slice of the range, of a non-empty sorted set; an empty slice borrows one."""
    at = np.minimum(np.searchsorted(hashes, _EDGES), len(hashes) - 1)
    low = hashes[at]
    full = (low >> U(64 - 7)) == _EACH.astype(U)
    lender = _LENDERS[_EACH, full[_LENDERS].argmax(axis=1)]
    return low[lender]


def bands(low: np.ndarray) -> np.ndarray:
    """64-bit band keys of signatures (one per row), different in different bands."""
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U), (len(low), BANDS))
        for i in range(ROWS):
            key = mix(key * U(0x9E3779B97F4A7C15) + low[:, i::ROWS])
    return key.view(np.int64)


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    """The parity bitmap of the smallest hashes of a sorted set."""
    bit = (mix(hashes[:FOLDED]) & U(BITS - 1)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=BITS) & 1).astype(np.uint8))


def differing_limit(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """In how many bits the sketches of sets of ``n`` and ``m`` elements may differ if they are similar enough."""
    n, m = np.asarray(n, float), np.asarray(m, float)
    common = percent * (n + m) / (100 + percent)
    part = np.minimum(np.minimum(FOLDED / n, FOLDED / m), 1)
    slack = np.where(part < 1, 12 * np.sqrt(common * part * (1 - part * common / np.maximum(n, m))) + 4, 0)
    return np.minimum(n, FOLDED) + np.minimum(m, FOLDED) - 2 * common * part + slack + 1e-6


def alike(n: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs sizes and sketches (bytes in rows) leave open."""
    sized = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    differ = np.bitwise_count(a.view(U) ^ b.view(U)).sum(axis=-1)
    return sized & (differ <= differing_limit(n, m, percent))


def _signatures(docs: DataFrame, size: int) -> DataFrame:
    def work(batches):
        for b in batches:
            sets = [shingles(t.as_py(), size) for t in b.column("text")]
            some = [s for s in sets if len(s)]
            keys = iter(bands(np.stack([samples(s) for s in some])) if some else [])
            sums = np.array([set_sums(s) for s in sets], np.int64).reshape(-1, 2)
            yield {
                "doc_id": b.column("doc_id"), "n": [len(s) for s in sets], "set_a": sums[:, 0], "set_b": sums[:, 1],
                "bands": (own := [next(keys) if len(s) else [] for s in sets]),
                "keys": [np.asarray(k, np.int64).tobytes() for k in own], "sketch": [odd_sketch(s).tobytes() for s in sets],
            }

    schema = "doc_id bigint, n bigint, set_a bigint, set_b bigint, bands array<bigint>, keys binary, sketch binary"
    return map_arrow(docs, work, schema)


def _alike(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` that sizes and sketches leave open."""

    def side(c: str) -> DataFrame:
        return marks.select(F.col("doc_id").alias(f"_{c}"), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))

    both = pairs.join(side("a"), F.col("a") == F.col("_a")).select("a", "b", "na", "sa")
    both = both.join(side("b"), F.col("b") == F.col("_b")).filter(
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    )

    def work(batches):
        for b in batches:
            sa, sb = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, BITS // 8) for c in ("sa", "sb"))
            good = alike(b.column("na").to_numpy(), b.column("nb").to_numpy(), sa, sb, percent)
            yield {c: b.column(c).to_numpy()[good] for c in ("a", "b")}

    return map_arrow(both.select("a", "b", "na", "nb", "sa", "sb"), work, "a bigint, b bigint")


def _open_buckets(members: DataFrame) -> DataFrame:
    """``_b`` and ``_n`` (rows) of the buckets that hold several components."""
    return cut(
        members.groupBy(F.col("band").alias("_b"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("label").alias("_lo"), F.max("label").alias("_hi"))
        .filter("_n > 2 and _lo <> _hi").select("_b", "_n")
    )


def _block_pairs(
    members: DataFrame, buckets: DataFrame, percent: int, tree: int | None = None, blocks: DataFrame | None = None
) -> DataFrame:
    """``band lo hi a b more``: pairs of one bucket but of different components that sizes and sketches leave open, by block.

    With ``tree``, a number that changes the choice, no more pairs of a block than join the components which the open ones join;
    a block that left a pair out has a row with ``more`` and no pair. With ``blocks`` (``band lo hi``) only these meet.
    """
    n_blocks = F.ceil(F.col("_n") / F.lit(BLOCK)).cast("int")
    placed = (
        members.join(buckets, F.col("band") == F.col("_b"))
        .withColumn("mine", F.pmod(F.xxhash64("doc_id"), n_blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        .withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other"))
    )
    if blocks is not None:
        placed = placed.join(blocks, ["band", "lo", "hi"], "left_semi")

    nothing = pd.DataFrame({"band": [0], "lo": [0], "hi": [0], "a": [0], "b": [0], "more": [False]})[:0]

    def pairs(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        across = key[1] != key[2]
        if tree is not None:
            chance = mix(group["doc_id"].to_numpy().astype(np.int64).view(U) ^ U(tree + 1))
            group = group.iloc[np.argsort(chance, kind="stable")]
        sketch = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(-1, BITS // 8)
        keys = np.frombuffer(b"".join(group["bands"]), np.int64).reshape(-1, BANDS)
        label, n, doc, mine = (group[c].to_numpy() for c in ("label", "n", "doc_id", "mine"))
        names, part = np.unique(label, return_inverse=True)
        joined = np.arange(len(names))
        out, left_out = [np.zeros((0, 2), np.int64)], False
        for i in np.flatnonzero(mine == key[1]):
            # Two blocks meet across; in a block that meets itself each pair is seen once.
            others = ((mine != mine[i]) if across else np.arange(len(doc)) > i) & (part != part[i])
            at = np.flatnonzero(others & (joined[part] != joined[part[i]]))
            left_out |= len(at) < others.sum()
            at = at[alike(n[at], np.full(len(at), n[i]), sketch[at], sketch[i : i + 1], percent)]
            # Rows of a repeated id may share no key; they are taken wherever they meet.
            same = keys[at] == keys[i]
            at = at[(keys[i][same.argmax(axis=1)] == key[0]) | ~same.any(axis=1)]
            if tree is not None:
                found, first = np.unique(joined[part[at]], return_index=True)
                left_out |= len(first) < len(at)
                at = at[first]
                joined[np.isin(joined, found)] = joined[part[i]]
            out.append(np.stack([np.minimum(doc[at], doc[i]), np.maximum(doc[at], doc[i])], 1))
        if left_out:
            out.append(np.zeros((1, 2), np.int64))
        a, b = np.concatenate(out).T
        if not len(a):  # as most blocks have it
            return nothing
        more = np.zeros(len(a), bool)
        more[len(a) - left_out :] = True
        return pd.DataFrame({"band": key[0], "lo": key[1], "hi": key[2], "a": a, "b": b, "more": more}, index=range(len(a)))

    fields = ["band", "lo", "hi", "mine", "doc_id", "label", "n", "sketch", "bands"]
    return placed.select(*fields).groupBy("band", "lo", "hi").applyInPandas(
        pairs, "band bigint, lo int, hi int, a bigint, b bigint, more boolean"
    )


def _pairs_of(met: DataFrame) -> DataFrame:
    return met.filter("not more").select("a", "b").distinct()


def _open_pairs(members: DataFrame, buckets: DataFrame, percent: int, tree: int | None = None) -> DataFrame:
    """The pairs ``a``, ``b`` of ``_block_pairs``, each once."""
    return _pairs_of(_block_pairs(members, buckets, percent, tree))


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``: one row per input row.

    Documents are linked if their sets of ``size``-word shingles have at least ``percent`` (80 or more) in common;
    ``component_id`` is the smallest id reached over links, and the document with that id stays. A null or empty text
    and one without words has an empty set and no links. A text of fewer words is one shingle. Rows that
    repeat an id are one document, linked where one of its texts is. A null id counts as the smallest bigint.
    Other columns play no part.
    """
    if percent < 80:
        raise ValueError("the bands are laid out for 80 per cent and more")
    plain = texts(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"), "text")
    with bounded_batches(docs.sparkSession):
        marks = cut(_signatures(plain, size))

    # Classes of equal sets, found on the sums of their hashes.
    sets = ["n", "set_a", "set_b"]
    small = marks.filter("n > 0").select("doc_id", *sets)
    # Checkpointed, like all groups below that rows are joined with: the join then has a plain exchange on either
    # side, and AQE can split a group that holds a large part of the rows.
    classes = cut(small.groupBy(*[F.col(c).alias("_" + c) for c in sets]).agg(F.min("doc_id").alias("rep")))
    same_set = (F.col("n") == F.col("_n")) & (F.col("set_a") == F.col("_set_a")) & (F.col("set_b") == F.col("_set_b"))
    class_of = cut(small.join(classes, same_set).select("doc_id", "rep"))
    nodes = cut(class_of.select(F.col("rep").alias("node")).distinct())
    several = class_of.groupBy(F.col("doc_id").alias("_i")).agg(F.min("rep").alias("a"), F.max("rep").alias("m")).filter("a <> m")
    ties = several.join(class_of, F.col("doc_id") == F.col("_i")).select("a", F.col("rep").alias("b")).filter("a <> b")

    # Step 2: every member of a bucket with the smallest one.
    in_band = marks.select("doc_id", F.explode("bands").alias("band")).join(nodes, F.col("doc_id") == F.col("node"), "left_semi")
    hubs = cut(
        in_band.groupBy(F.col("band").alias("_b")).agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("_m")).filter("hub <> _m")
    )
    shared = cut(in_band.join(hubs.select("_b", "hub"), F.col("band") == F.col("_b")).select("doc_id", "band", "hub"))
    active = cut(marks.select("doc_id", "n", "sketch", "keys").join(shared.select(F.col("doc_id").alias("_i")), F.col("doc_id") == F.col("_i"), "left_semi"))
    with_hub = shared.filter("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    with bounded_batches(docs.sparkSession):
        tested = cut(_alike(with_hub, active, percent))
    edges = linked(plain, tested, size, percent).unionByName(ties)
    label = cut(components(nodes, edges, ONE_TASK_EDGES))

    # Step 3: what is left between components. A block that left no pair out is done with.
    blocks = None
    for tree in [*range(TREE_ROUNDS), None]:
        labelled = active.join(label, F.col("doc_id") == F.col("node")).select(
            F.col("doc_id").alias("_i"), "label", "n", "sketch", F.col("keys").alias("bands")
        )
        within = shared if blocks is None else shared.join(blocks.select("band").distinct(), "band", "left_semi")
        members = within.select("doc_id", "band").join(labelled, F.col("doc_id") == F.col("_i")).drop("_i")
        buckets = _open_buckets(members)
        if buckets.isEmpty():
            break
        met = cut(_block_pairs(members, buckets, percent, tree, blocks))
        blocks = met.filter("more").select("band", "lo", "hi")
        untested = cut(_pairs_of(met).join(tested, ["a", "b"], "left_anti"))
        if untested.isEmpty():
            continue
        tested = tested.unionByName(untested)
        label = merged(label, linked(plain, untested, size, percent))
    component = (
        class_of.join(label, F.col("rep") == F.col("node"))
        .groupBy(F.col("doc_id").alias("_i")).agg(F.min("label").alias("root"))
    )
    return (
        marks.select("doc_id", F.col("n").alias("n_shingles"))
        .join(component, F.col("doc_id") == F.col("_i"), "left")
        .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that ``near_duplicates`` does not keep; all columns stay, whatever their names.

    Rows that repeat an id, and rows with a null id, are one document and go or stay together. An empty table stays empty.
    """
    (own,) = unused(docs, "_i")
    gone = near_duplicates(docs, size, percent, id_col, text_col).filter("not kept").select(F.col("doc_id").alias(own)).distinct()
    return docs.join(gone, F.coalesce(docs[id_col].cast("bigint"), F.lit(-(2**63))) == F.col(own), "left_anti")
