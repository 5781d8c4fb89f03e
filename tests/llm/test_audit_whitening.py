"""Filter audit and whitening against plain versions, on small and on awkward inputs."""

from __future__ import annotations

import math
import random
import re
from itertools import permutations

import numpy as np
import pytest

from bikeflow.llm import filter_audit, whitening

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, source string, part string, mask int, n bigint, good int, first boolean, digest binary, rank int"
LABELS = "doc_id bigint, quality int, toxic int, part string, good int"


def filter_rows():
    r = random.Random(4)
    long = " ".join(f"word{i}" for i in range(250))
    texts = [long, long, long + " #", "Short TEXT", "short text", "", None, "a " * 300, "CAPS " * 300, long.upper() + " &", "é $ é", "x" * 9000, "\n \t"]
    rows = [(i, r.choice(texts), r.choice(["s1", "s2", None, ""])) for i in range(60)]
    rows += [(3, long, "s1"), (3, long, "s2"), (0, "same", "s1"), (0, "same", "s1"), (None, long, "s2"), (None, None, None)]
    return [(*row, "p", 1, 5, 1, False, b"x", 3) for row in rows]


LABEL_ROWS = [(i, 1 if i % 3 else 0, 1 if i % 5 == 0 else None, "q", 0) for i in range(0, 60, 2)] + [(4, 1, 0, "q", 0), (4, 0, 1, "q", 0), (None, 1, 1, "q", 1)]


def played_through(rows, labels):
    good = {d for d, q, *_ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t, *_ in labels if t == 1 and d is not None}
    docs = []
    for d, text, source, *_ in rows:
        t = text or ""
        w = WORDS.findall(t)
        copy = d is not None and any(e is not None and e < d and (u or "") == t for e, u, *_ in rows)
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), any(c in "#$%&*|" for c in t), copy]
        docs.append((source or "", {f for f, x in zip("ABCDE", fails, strict=True) if x}, d in good, d in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        share = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone, left = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                share[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[1] for d in mine) - len(gone), sum(d[1] == {f} for d in mine),
                    sum(d[2] for d in gone), sum(d[3] for d in gone),
                ]
        for key in [k for k in out if k[0] == part]:
            out[key].append(share[key[1][key[2] - 1]])
    return out


def test_filter_audit_equals_every_order_played_through(spark):
    rows = filter_rows()
    got = filter_audit.audit(spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(LABEL_ROWS, LABELS)).collect()
    fields = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r.part, r.filter_order, r.step): [r[f] for f in fields] for r in got} == played_through(rows, LABEL_ROWS)
    assert len(got) == len({d[2] or "" for d in rows}) * 600


def test_filter_audit_of_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs, labels).count() == 0
    got = filter_audit.audit(spark.createDataFrame([(1, "a", "s", *[None] * 7)], DOCS), labels).filter("step = 1").collect()
    assert {(r.filter_order[0], r.removed, r.good_lost) for r in got} == {("A", 1, 0), *((f, 0, 0) for f in "BCDE")}


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_intervals_cover_each_order_of_each_mask_once(n):
    orders = list(permutations(range(n)))
    for mask in range(1, 1 << n):
        steps = [0] * len(orders)
        for m, step, lo, hi in filter_audit.removal_intervals(n):
            if m == mask:
                assert not any(steps[lo:hi])
                steps[lo:hi] = [step] * (hi - lo)
        assert steps == [1 + min(o.index(f) for f in range(n) if mask >> f & 1) for o in orders]


def test_interactions_of_other_filters(spark):
    masks = spark.createDataFrame([("p", 1, 3), ("p", 3, 2), ("p", 0, 4), ("q", 0, 1)], "part string, mask int, n bigint")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.shapley) for r in filter_audit.interactions(masks, ["a", "b"], {}).collect()}
    assert got == {
        ("p", "ab", 1): (4, 5, 8), ("p", "ab", 2): (4, 0, 2), ("p", "ba", 1): (7, 2, 2), ("p", "ba", 2): (4, 3, 8),
        ("q", "ab", 1): (1, 0, 0), ("q", "ab", 2): (1, 0, 0), ("q", "ba", 1): (1, 0, 0), ("q", "ba", 2): (1, 0, 0),
    }
    with pytest.raises(ValueError):
        filter_audit.interactions(masks, ["b", "a"], {})


VECTORS = "vec_id bigint, embedding array<float>, label int, x bigint, v string, n bigint"


def vector_rows():
    r = np.random.default_rng(5)
    base = r.normal(size=(120, 9)) @ r.normal(size=(9, 9)) * 0.4 + r.normal(size=9)
    rows = [v.tolist() for v in base] + [base[0].tolist()] * 40
    rows += [None, [], [1.0, 2.0], [float("nan")] * 9, [1.0] * 8 + [None], [float("inf"), *[0.0] * 8], [-0.0] * 9]
    return [(i if i % 11 else None, v, 1, 2, "v", 3) for i, v in enumerate(rows)]


def on_grid(rows, dims):
    out = []
    for i, v, *_ in rows:
        if v and len(v) == dims and all(c is not None and math.isfinite(c) for c in v):
            out.append((i, tuple(math.floor(256 * float(np.float32(c))) for c in v)))
    return out


def check_whitened(got, x, k):
    fit = sorted({v for _, v in x})
    n, dims = len(fit), len(fit[0])
    total = [sum(v[j] for v in fit) for j in range(dims)]
    y = np.array(fit, float) - np.array(total) / n
    cov = y.T @ y / n
    values, units = np.linalg.eigh(cov)
    values, units = values[::-1], units[:, ::-1]
    assert len(got) == len(x) * k
    want = {}
    for i, v in x:
        for c in range(k):
            w = (np.array(v, float) - np.array(total) / n) @ units[:, c] / math.sqrt(values[c])
            want.setdefault((i or -1, c + 1, sum((n * a - s) ** 2 for a, s in zip(v, total, strict=True))), []).append(w)
    sign = {}
    for r in got:
        at = want[r.vec_id or -1, r.component, r.deviation]
        w = min(at, key=lambda w: abs(abs(w) - abs(r.whitened)))
        at.remove(w)
        if abs(w) > 1e-6:
            assert sign.setdefault(r.component, w * r.whitened > 0) == (w * r.whitened > 0)
        assert abs(abs(w) - abs(r.whitened)) < 1e-8 and r.n == n
        assert r.explained == pytest.approx(values[r.component - 1] / cov.trace(), rel=1e-10) and r.identity_error < 1e-9


def test_whitening_equals_a_plain_decomposition(spark):
    rows = vector_rows()
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(5)).collect()
    check_whitened(got, on_grid(rows, 9), 4)


def test_whitening_of_few_dimensions_and_little_spread(spark):
    def run(vectors):
        rows = [(i, v, 0, 0, "", 0) for i, v in enumerate(vectors)]
        return whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()

    assert run([]) == [] and run([[1.0, 2.0]] * 3) == [] and run([None, []]) == []
    line = [[float(i), 2.0 * i, 5.0] for i in range(4)]  # rank one
    got = run(line)
    assert [r.component for r in got] == [1] * 4 and all(r.explained == pytest.approx(1) for r in got)
    two = [[0.5 * i, float(i * i % 7)] for i in range(9)]
    check_whitened(run(two), on_grid([(i, v) for i, v in enumerate(two)], 2), 2)
    far = [[1e6 + (i % 3), 1e6 + (i % 5) / 16, float(i)] for i in range(15)]  # means far above the spread
    rows = [(i, v) for i, v in enumerate(far)]
    check_whitened(run(far), on_grid(rows, 3), 3)


def test_deviation_beyond_a_bigint_is_null(spark):
    rows = [(i, [v, 0.0], 0, 0, "", 0) for i, v in enumerate([1e30, -1e30, 3.0])]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    # the third vector lies so near the mean of the other two that its own deviation fits
    assert {r.vec_id: r.deviation for r in got} == {0: None, 1: None, 2: (3 * 768 - 768) ** 2}


def test_factor_and_rotation_of_awkward_matrices():
    r = np.random.default_rng(1)
    for d in (1, 2, 3, 8, 33):
        base = r.normal(size=(d, d)) * 10.0 ** r.integers(-4, 4, size=d)[:, None]
        a = base @ base.T
        f = whitening.pivoted_cholesky(a)
        assert np.allclose(f @ f.T, a, atol=1e-9 * np.abs(a).max())
        g = whitening.one_sided_jacobi(f)
        gram = g.T @ g
        scale = np.sqrt(np.outer(np.diag(gram), np.diag(gram)))
        assert (np.abs(gram - np.diag(np.diag(gram))) <= 1e-13 * scale).all()
        assert np.allclose(sorted((g**2).sum(0))[-1], np.linalg.eigvalsh(a)[-1])
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
    ones = whitening.one_sided_jacobi(whitening.pivoted_cholesky(np.ones((4, 4))))
    assert ones.shape == (4, 1) and np.allclose((ones**2).sum(), 4)
