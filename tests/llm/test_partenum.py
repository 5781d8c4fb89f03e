"""The PartEnum join against all pairs, and its signatures against their promise."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from bikeflow.llm import partenum
from bikeflow.llm.hashing import U, mix

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, sig bigint, hub bigint, n bigint, label bigint, bits binary"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_sets(rows, size):
    out = {}
    for d, t, *_ in rows:
        w = WORDS.findall(low(t))
        s = frozenset(tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))) if w else frozenset()
        out.setdefault(-(2**63) if d is None else d, []).append(s)
    return out


def all_pairs(rows, size, percent):
    sets = shingle_sets(rows, size)
    label = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a, xs in sets.items():
            for b, ys in sets.items():
                if label[a] > label[b] and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in xs for y in ys):
                    label[a], changed = label[b], True
    return sorted((d, len(s), label[d]) for d, some in sets.items() for s in some)


def joined(spark, rows, size, percent):
    df = spark.createDataFrame([(d, t, 1, 2, 3, 4, b"") for d, t in rows], SCHEMA).repartition(3)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in partenum.join_components(df, size, percent).collect())


def edited(r, words, edits):
    out = list(words)
    for k in r.sample(range(len(out)), edits):
        out[k] = f"e{r.randrange(10**6)}"
    return " ".join(out)


def awkward_rows():
    r = random.Random(8)
    rows = [(0, ""), (1, None), (2, " \n\t"), (3, "One two"), (4, "one  TWO"), (5, "one two three four five"), (None, "one two"), (None, None)]
    for family in range(6):  # families around a base, with members at and about the limit, and copies
        words = [f"w{family}x{i}" for i in range(r.choice([12, 30, 60, 90]))]
        rows += [(len(rows), " ".join(words).upper())] * 2
        rows += [(len(rows) + i, edited(r, words, r.randint(0, 3))) for i in range(12)]
        rows += [(len(rows), " ".join(words[: -r.randint(1, 6)]))]
    long = [f"l{r.randrange(900)}" for _ in range(9000)]
    rows += [(1000, " ".join(long)), (1001, edited(r, long, 150)), (1002, edited(r, long, 400)), (1003, "z" * 20000)]
    # an id with two texts joins two families
    return rows + [(1004, rows[9][1]), (1004, rows[40][1])]


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (1, 80), (5, 80)])
def test_components_equal_all_pairs(spark, size, percent):
    rows = awkward_rows()
    assert joined(spark, rows, size, percent) == all_pairs(rows, size, percent)


def test_a_family_without_a_centre_meets_in_blocks(spark, monkeypatch):
    r = random.Random(2)
    words = [f"c{i}" for i in range(40)]
    rows = [(i, edited(r, words, 4)) for i in range(70)] + [(100 + i, edited(r, words, 3)) for i in range(20)]
    want = all_pairs(rows, 1, 85)
    assert len({c for *_, c in want}) > 10
    monkeypatch.setattr(partenum, "HUB_ROUNDS", 1)
    monkeypatch.setattr(partenum, "BLOCK", 9)
    assert joined(spark, rows, 1, 85) == want


def test_empty_table_and_bounds(spark):
    assert joined(spark, [], 4, 85) == []
    assert joined(spark, [(1, None), (2, "")], 4, 85) == [(1, 0, 1), (2, 0, 2)]
    with pytest.raises(ValueError):
        partenum.join_components(spark.createDataFrame([], SCHEMA), percent=100)


def hashes(r, n):
    return np.sort(mix(np.array(r.sample(range(1 << 40), n), U)))


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_linked_sets_share_a_signature(percent):
    r = random.Random(percent)
    for _ in range(1500):
        n = r.choice([partenum.least_size(percent), 7, 9, 13, 20, 31, 57, 120, 400, 2500])
        m = r.randint(n, n * 100 // percent)  # the most that the two sets may differ in, spread at random
        same = -(-percent * (n + m) // (100 + percent))
        if same > n:
            continue
        pool = hashes(r, n + m - same)
        r_at = np.array(r.sample(range(len(pool)), len(pool)))
        a, b = np.sort(pool[r_at[:n]]), np.sort(np.r_[pool[r_at[:same]], pool[r_at[n:]]])
        assert len(b) == m and partenum.may_link(n, m, partenum.bitmap(a), partenum.bitmap(b), percent)
        if n < partenum.least_size(percent):
            assert n == m == same
            continue
        assert np.intersect1d(partenum.signatures(a, percent), partenum.signatures(b, percent)).size


def test_sets_in_one_corner_of_the_domain_still_share():
    # all elements in one part of the domain: nearly every projection is empty, and must be listed
    a = np.arange(1, 41, dtype=U)
    b = np.r_[a[:38], U(100), U(101)]
    c = np.arange(1000, 1040, dtype=U)
    own, other = partenum.signatures(a, 85), partenum.signatures(b, 85)
    assert np.intersect1d(own, other).size and np.intersect1d(own, partenum.signatures(c, 85)).size


def test_unlike_sets_share_nothing_and_bitmaps_refute():
    r = random.Random(3)
    for n in (12, 60, 500):
        a = hashes(r, n)
        half = np.sort(np.r_[a[::2], hashes(r, n - len(a[::2]))])
        assert not np.intersect1d(partenum.signatures(a, 85), partenum.signatures(hashes(r, n), 85)).size
        assert not partenum.may_link(n, n, partenum.bitmap(a), partenum.bitmap(half), 85)
    assert partenum.signatures(hashes(r, 5), 85).size == 0


def test_folded_bitmaps_are_those_of_the_smaller_size():
    r = random.Random(1)
    a = hashes(r, 300)
    long = partenum.bitmap(a)
    for words in (4, 8, 16):
        with np.errstate(over="ignore"):
            at = mix(a + U(partenum.BASE)) & U(words * 64 - 1)
        odd = (np.bincount(at.astype(np.int64), minlength=words * 64) & 1).astype(np.uint8)
        assert (partenum.fold(long, words) == np.packbits(odd).view(U)).all()
