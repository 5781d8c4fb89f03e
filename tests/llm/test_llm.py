"""Operators of the llm package against plain versions, on small and on awkward inputs."""

from __future__ import annotations

import base64
import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from bikeflow.llm import (
    bpe,
    digest_index,
    extract,
    language,
    merkle,
    mixing,
    near_dup,
    pii,
    queries,
    substring,
    token_store,
)
from bikeflow.plans.runtime import scratch

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, extra string, row bigint, kept string"


def prose(seed, n, alphabet="abcdefg"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(2, 6))) for _ in range(n))


def corpus():
    """Copies, near copies, shared passages, a hot group, nulls, empty and long texts; ids out of order."""
    base, passage = prose(1, 120), prose(2, 70)
    near = [" ".join("x" if i == k else w for i, w in enumerate(base.split())) for k in (3, 60, 110)]
    out = [base, base, *near, passage, prose(3, 40) + "\n" + passage + " " + prose(4, 30), passage + passage]
    out += ["one two three", "One  TWO\tthree", "", None, " \n ", "na\x1cive café x 'll it's　y", "a" * 3000]
    out += ["same words here " * 20] * 12 + [prose(5, 3000), "1 2 3 4.5 !!! ???", prose(6, 49), prose(6, 49)]
    return [(len(out) * 3 - 3 * i, t, "ab"[i % 2] if i % 5 else None, [None, "s", "hot"][i % 7 % 3], "e", 9, "k") for i, t in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def sets(size):
    out = {}
    for d, t, *_ in corpus():
        w = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        out[d] = {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()
    return out


def test_near_duplicates_equal_all_pairs(docs):
    shingle = sets(4)
    low = {d: d for d in shingle}
    changed = True
    while changed:
        changed = False
        for a, x in shingle.items():
            for b, y in shingle.items():
                if x and y and 100 * len(x & y) >= 80 * len(x | y) and low[a] > low[b]:
                    low[a], changed = low[b], True
    got = by_id(near_dup.near_duplicates(docs, size=4))
    assert {d: (len(shingle[d]), low[d], low[d] == d) for d in shingle} == {
        d: (r["n_shingles"], r["component_id"], r["kept"]) for d, r in got.items()
    }


def test_blocks_of_a_bucket_meet_in_all_ways(spark, monkeypatch):
    r = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):  # a large group of near copies, of which many pairs are no links
        words = list(base)
        for k in r.sample(range(60), 3):
            words[k] = f"v{i}-{k}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = by_id(near_dup.near_duplicates(df, size=1))
    monkeypatch.setattr(near_dup, "BLOCK", 7)
    assert by_id(near_dup.near_duplicates(df, size=1)) == whole


def test_pairs_of_a_family_grow_with_its_members(spark):
    n, own = 200, np.arange(1, near_dup.BANDS + 1, dtype=np.int64)
    sketch = near_dup.odd_sketch(np.arange(300, dtype=np.uint64))
    rows = [(d, int(own[b]), d, 300, bytearray(sketch.tobytes()), bytearray(own.tobytes())) for d in range(n) for b in range(2)]
    members = spark.createDataFrame(rows, "doc_id bigint, band bigint, label bigint, n bigint, sketch binary, bands binary")
    buckets = near_dup._open_buckets(members)
    tree = {(r.a, r.b) for r in near_dup._open_pairs(members, buckets, 80, 0).collect()}
    assert len(tree) == n - 1 and tree != {(r.a, r.b) for r in near_dup._open_pairs(members, buckets, 80, 1).collect()}
    # In full every pair comes, from the first bucket that it shares only.
    assert near_dup._open_pairs(members, buckets, 80).count() == n * (n - 1) // 2
    assert near_dup._open_pairs(members.filter("band = 2"), buckets, 80).count() == 0


def test_a_block_without_open_pairs_meets_once(spark, monkeypatch):
    """A block is met again only if it left pairs out; one that did gives the rest then."""
    own = np.arange(1, near_dup.BANDS + 1, dtype=np.int64)
    like = near_dup.odd_sketch(np.arange(300, dtype=np.uint64)).tobytes()
    unlike = [near_dup.odd_sketch(np.arange(1000 * i, 1000 * i + 300, dtype=np.uint64)).tobytes() for i in range(1, 6)]
    rows = [(d, 1, d, 300, bytearray(like), bytearray(own.tobytes())) for d in range(5)]
    rows += [(10 + d, 77, 10 + d, 300, bytearray(unlike[d]), bytearray((own + 76).tobytes())) for d in range(5)]
    members = spark.createDataFrame(rows, "doc_id bigint, band bigint, label bigint, n bigint, sketch binary, bands binary")
    buckets = near_dup._open_buckets(members)
    met = near_dup._block_pairs(members, buckets, 80, 0).collect()
    assert sum(not r.more for r in met) == 4 and [(r.band, r.lo, r.hi) for r in met if r.more] == [(1, 0, 0)]
    rest = spark.createDataFrame([(1, 0, 0)], "band bigint, lo int, hi int")
    assert {r.band for r in near_dup._block_pairs(members, buckets, 80, None, rest).collect()} == {1}
    assert near_dup._block_pairs(members, buckets, 80, None, rest).count() == 10

    asked = []
    plain = near_dup._block_pairs

    def watched(members, *rest):
        asked.append(members.select("band").distinct().count())
        return plain(members, *rest)

    monkeypatch.setattr(near_dup, "_block_pairs", watched)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words[:i], f"v{i}", *words[i + 1 :]]) for i in range(0, 60, 6)]
    texts += [" ".join([*words[:40], *(f"u{i}-{k}" for k in range(20))]) for i in range(10)]
    near_dup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), size=1).count()
    assert all(b < a for a, b in zip(asked, asked[1:]))


def test_near_copies_that_need_many_links_are_joined(spark):
    """Chains in one bucket: each text is like its neighbours only, and the rounds must not lose a link."""
    r = random.Random(8)
    words = [f"c{i}" for i in range(100)]
    rows, seen = [], []
    for i in range(40):
        words[r.randrange(100)] = f"x{i}"
        words[r.randrange(100)] = f"y{i}"
        rows.append((i * 7 % 40, " ".join(words)))
        seen.append((i * 7 % 40, set(words)))
    low = {d: d for d, _ in seen}
    for _ in seen:
        for a, x in seen:
            for b, y in seen:
                if 100 * len(x & y) >= 80 * len(x | y):
                    low[a] = low[b] = min(low[a], low[b])
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {d: r["component_id"] for d, r in by_id(near_dup.near_duplicates(df, size=1)).items()} == low


def test_an_index_has_a_bucket_for_every_task_of_a_shuffle(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.createDataFrame([(i, f"t{i % 50}") for i in range(300)], "doc_id bigint, text string")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "70")
        assert digest_index.deduplicate(df, "wide_index", "one").filter("kept").count() == 50
        assert {r.col_name: r.data_type for r in spark.sql("DESCRIBE FORMATTED wide_index").collect()}["Num Buckets"] == "70"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sql("DROP TABLE IF EXISTS wide_index")


def test_repeated_passages_equal_window_by_window(docs):
    words = {d: WORDS.findall(t or "") for d, t, *_ in corpus()}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - 49):
            first.setdefault(tuple(words[d][i : i + 50]), d)
    got = by_id(substring.remove_repeats(docs, with_text=True))
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < d:
                gone[i : i + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        r = got[d]
        assert (r["n_words"], r["n_removed"], r["kept"]) == (len(w), sum(gone), kept)
        assert r["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_texts_under_one_id_lose_only_what_a_smaller_document_has(spark):
    passage, other, third = prose(1, 60), prose(2, 90), prose(3, 90)
    rows = [(1, passage), (7, f"{other} {passage}"), (7, third), (7, f"{prose(4, 5)} {passage} {prose(5, 40)}"), (9, f"x {third}"), (9, prose(6, 200))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id, r.kept) for r in substring.remove_repeats(df, with_text=True).collect())
    kept = [passage, other, third, f"{prose(4, 5)} {prose(5, 40)}", "x", prose(6, 200)]
    assert got == sorted(zip((d for d, _ in rows), kept, strict=True))


def test_language_on_held_out_documents_and_odd_texts(spark):
    rows = [(i, prose(i, 30, "abcde" if i % 2 else "defgh"), "xy"[i % 2]) for i in range(200)]
    rows += [(1000, None, "x"), (1001, "", "x"), (1002, "12 !?", "y"), (1003, prose(7, 2), None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.train(df)
    got = by_id(language.identify(df, model))
    for d, t, lang in rows:
        assert got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= got[d]["score"] <= 1
        if t is None or not any(c.isalpha() for c in t):
            assert (got[d]["lang_pred"], got[d]["score"]) == ("und", 0.0)
        elif lang and got[d]["held_out"]:
            assert got[d]["lang_pred"] == lang
    assert 1000 not in by_id(language.keep_known(df, model))
    # Code lengths add up over bytes and are those of the counts: nothing is coded below zero bits.
    assert (model.cost >= 0).all()
    a = model.n_symbols
    total = np.exp2(-model.cost.reshape(-1, a, len(model.languages)).astype(float)).sum(axis=1)
    assert (total < 1.05).all()


def test_language_without_training_rows(empty):
    model = language.train(empty)
    assert model.predict("text") == ("und", 0.0)
    assert language.identify(empty, model).count() == 0


def test_a_rare_language_keeps_its_grams(spark):
    rows = [(i, prose(i, 40, "abcde"), "x") for i in range(150)] + [(200 + i, prose(i, 40, "pqrstuvw"), "y") for i in range(4)]
    model = language.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert model.languages == ["x", "y"]
    assert model.predict(prose(77, 5, "pqrstuvw"))[0] == "y" and model.predict(prose(78, 5, "abcde"))[0] == "x"


def test_code_lengths_with_many_languages():
    grams, counts = {}, {}
    for k in range(400):
        counts[f"l{k:03}"] = seen = Counter()
        raw = b"\n\n\n" + prose(k, 30, "abcdefghijklmnopqrstuvwxyz"[k % 20 : k % 20 + 6]).encode()
        for i in range(3, len(raw)):
            seen[raw[i - 3 : i + 1]] += 1
        grams[f"l{k:03}"] = (np.array([int.from_bytes(g, "big") for g in seen]), np.array(list(seen.values()), float))
    model, text = language.Model(grams), ("\n\n\n" + prose(7, 20, "hijklm") + " Z").encode()
    for lang in ("l007", "l207", "l399"):  # prediction by partial matching, byte by byte
        bits = 0.0
        for i in range(3, len(text)):
            for order in (3, 2, 1, 0):
                after = Counter()
                for g, n in counts[lang].items():
                    if g[3 - order : 3] == text[i - order : i]:
                        after[g[3]] += n
                if after[text[i]]:
                    bits += np.log2((sum(after.values()) + len([n for n in after.values() if n])) / after[text[i]])
                    break
                d = len([n for n in after.values() if n])
                bits += np.log2((sum(after.values()) + d) / d) if d else 0
            else:
                bits += 8
        got = model.bits(text[3:])[model.languages.index(lang)]
        assert abs(got - bits) < 1e-3 * bits


def test_pages(spark):
    page = (
        "<html><head><title>t</title><script>var a='<p>no</p>'</script></head><body><nav><ul><li>menu</ul></nav>"
        "<div class='site-header'>head</div><article><h1>T &amp; x</h1><p>a\n b<p>c <b>d</b><div id=comments><p>no</div></article>"
        "<aside>side</aside><form>f</form><footer>foot</footer></body></html>"
    )
    plain = "<body><div>a&lt;b</div><p>x<br>y<!-- <p>z --></p><div class=ad>buy</div>"
    rows = [(1, "http://h.example/1", page), (2, None, plain), (3, "bad", None), (4, "http://h.example/", ""), (5, "x", "<p class='")]
    rows += [(100 + i, f"http://site.example/{i}", f"<div class=t>Always the same</div><div class=b><p>{prose(i, 9)}</p></div>") for i in range(12)]
    got = by_id(extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")), "page_id")
    assert got[1]["text"] == "T & x\na b\nc d"
    assert got[2]["text"] == "a<b\nx y"
    assert got[3]["text"] == got[4]["text"] == got[5]["text"] == ""
    for i in range(12):  # what every page of the site repeats goes
        assert got[100 + i]["text"] == prose(i, 9)
        assert got[100 + i]["n_chars"] == len(prose(i, 9))


def test_importance_of_a_site_equals_plain_entropies(spark):
    pages = []
    for i in range(9):
        note = "same" if i < 7 else f"other {i}"
        pages.append(f"<article><h2>Ingredients</h2><p>{prose(i, 6)}</p><div class=n>{note}</div></article>")
    rows = [(i, "http://h.example/", p) for i, p in enumerate([*pages, pages[0], pages[0]])]  # copies count once
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {n["path"]: n for r in extract.site_trees(df).collect() for n in r["nodes"]}
    seen = {}
    for p in pages:
        for path, kinds in extract.observations(extract.parse(p)).items():
            for kind, value in zip(("look", "content"), kinds, strict=True):
                seen.setdefault(path, {}).setdefault(kind, Counter())[value] += 1
    low = 0
    for path, kinds in seen.items():
        worth = {}
        for kind, counts in kinds.items():
            shares = [n / (len(pages) + 1) for n in [*counts.values(), 1]]  # one more page, that differs
            worth[kind] = -sum(q * np.log2(q) for q in shares) / np.log2(len(pages) + 1)
        if min(worth.values()) < extract.LOW:
            low += 1
            assert all(abs(got[path][k] - worth[k]) < 1e-9 for k in worth)
        else:
            assert path not in got
    assert low
    text = by_id(extract.extract(df), "page_id")[0]["text"].split("\n")
    assert text[0] == "Ingredients" and text[1] == prose(0, 6)  # a shared heading stays in its articles


def test_few_pages_are_evidence_of_little(spark):
    def kept(n):
        rows = [(i, "http://h.example/", f"<article><p>{prose(i, 6)}</p><div class=x>Read more</div></article>") for i in range(n)]
        got = by_id(extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")), "page_id")
        return {"Read more" in r["text"] for r in got.values()}

    assert kept(1) == kept(2) == {True} and kept(12) == {False}


def test_names_in_an_article_and_deep_pages():
    page = (
        "<article><p>one two three</p><section class='search-theory'><p>four five</p></section><p class='form-of-state'>six</p>"
        "<div id='related-work'><p>seven</p></div><div class='post comments'>no</div></article>"
    )
    assert extract.main_text(page) == "one two three\nfour five\nsix\nseven"
    start = time.process_time()
    assert extract.main_text("<div>" * 20000 + "x" + "</b>" * 20000) == "x"
    assert extract.main_text("<article>" + "<div>" * 20000 + "<p>x" + "</section>" * 20000) == "x"
    assert time.process_time() - start < 10  # linear: far less than the minutes of a quadratic walk


def test_class_words_do_not_remove_the_article():
    body = "<article><h1>T</h1><p>one two three</p></article>"
    for wrapper in ("<div class='layout no-sidebar'>", "<div id=page-with-header>", "<div class=comments>"):
        assert extract.main_text(f"<body>{wrapper}{body}</div><div class=footer>{'end ' * 30}</div>") == "T\none two three", wrapper
    # Without an article most of the text stays, and what is named and small still goes.
    assert extract.main_text("<div class=with-sidebar><p>one two three four</p><div class=ad>buy</div></div><p>x") == "one two three four\nx"
    # Parts named so beside or in an article still go, however long comments are; so does all that a tag or role names.
    assert extract.main_text(f"{body}<div class=related><article>see also</article></div>") == "T\none two three"
    assert extract.main_text(f"<article><p>text</p><div class=comments>{'reply ' * 50}</div></article>") == "text"
    assert extract.main_text(f"<nav>{body}</nav><p>x") == "x"


def test_template_parts_in_articles_go_and_copied_articles_stay(spark):
    part = "<div class=x><p>Read more on our site</p></div>"
    rows = [
        (i, f"http://a.example/{i}", f"<article><h1>{prose(i, 3)}</h1><p>{prose(i + 50, 9)} <b>note</b> z<br>y</p>{part}</article>") for i in range(12)
    ]
    copied = f"<article><h1>{prose(99, 3)}</h1><p>{prose(98, 9)}</p></article>"
    rows += [(100 + i, f"http://b.example/{i}", f"<div class=q>{prose(i, 4)}</div>{copied}") for i in range(12)]
    got = by_id(extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")), "page_id")
    for i in range(12):
        assert got[i]["text"] == f"{prose(i, 3)}\n{prose(i + 50, 9)} note z y"
        assert got[100 + i]["text"] == f"{prose(99, 3)}\n{prose(98, 9)}"


def test_fingerprints_of_edited_texts(docs):
    rows = sorted(((d, t or "") for d, t, *_ in corpus()), reverse=True)
    got = by_id(merkle.compare_edited(docs))
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        edited = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        assert got[d]["n_chars"] == len(t)
        assert got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[d]["fingerprint"] == merkle.fingerprint(t)
        assert got[d]["near_next"] == merkle.likeness(merkle.fingerprint(t), merkle.fingerprint(after))
        assert (got[d]["near_next"] == 1.0) == (t == after)


def test_edits_are_located():
    a = "\n".join(prose(i, 12) + "." for i in range(40))
    lines = a.split("\n")
    lines[17] = "changed line."
    x, y = merkle.fingerprint(a), merkle.fingerprint("\n".join(lines))
    places = merkle.edits(x, y)
    assert len(places) == 1
    flat = [(i, j) for i, (_, ps) in enumerate(merkle.parse(x)) for j in range(len(ps))]
    assert flat.index(places[0]) == 17
    assert 0.9 < merkle.likeness(x, y) < 1


def test_mix_comes_near_its_targets(docs, spark):
    rows = [(i, prose(i, 5 + i * 7 % 60), ["big", "mid", "small", None][0 if i % 3 else 1 + i % 2 + (i % 9 == 0)]) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mixed = [r.asDict() for r in mixing.mix(df).collect()]
    sizes, taken, goal = Counter(), Counter(), {}
    for r in mixed:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, want = 1.5 * sum(sizes.values()), set(order), {}
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] < weight[s] * level}
        if not full:
            break
        want |= {s: 2 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    want |= {s: weight[s] * level for s in open_}
    for s in order:
        assert abs(goal[s] - want[s]) < 1e-6
        assert abs(taken[s] - want[s]) <= 35
    assert sorted(map(str, mixed)) == sorted(str(r.asDict()) for r in mixing.mix(df.repartition(5)).collect())
    assert mixing.mix(docs).count() == docs.count()


def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.BYTE_RANKS, "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_library_wherever_it_is_cut(docs):
    plain, r = encoding(), random.Random(5)
    small = bpe.Codec(queries.BYTE_RANKS, public_tokenizers.PATTERN, leaf=3)
    for _ in range(1500):
        text = "".join(r.choice("ab're'll 1é\n\t .\x1c 　日  ") for _ in range(r.randint(0, 40)))
        ids = small.encode(text)
        assert ids == plain.encode_ordinary(text), repr(text)
        assert small.decode(ids) == text.encode()
    got = by_id(bpe.round_trip(docs, queries.BYTE_RANKS, public_tokenizers.PATTERN, leaf=64))
    for d, t, *_ in corpus():
        ids = plain.encode_ordinary(t or "")
        assert got[d]["n_tokens"] == len(ids)
        assert got[d]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_personal_data():
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def plain(text):
        out = []
        for kind, p in patterns.items():
            for m in re.finditer(p, text):
                digits = re.sub("[^0-9]", "", m.group())
                good = {
                    "email": True, "ip": max(map(int, m.group().split(".")), default=0) <= 255 if kind == "ip" else True,
                    "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15,
                }
                if good[kind]:
                    out.append((kind, *m.span()))
        return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))

    r = random.Random(1)
    for _ in range(5000):
        text = "".join(r.choice("12.@+- (a%55.9") for _ in range(r.randint(0, 40)))
        assert pii.base_spans(text) == plain(text), repr(text)
    field = pii.trained()
    text = "été: dial (201) 555-9876, or version 2.0 of 4012-8888-8888-1883 now, 4012.8888.8888.1881 then"
    found = pii.added_spans(field, [text, "", "plain words 7"], [[], [], []])
    # A card passes Luhn, by the patterns or by the field.
    assert [(k, text[a:b]) for k, a, b in found[0]][:1] == [("phone", "(201) 555-9876")]
    assert all(k != "card" or pii.luhn(re.sub("[^0-9]", "", text[a:b])) for k, a, b in found[0])
    assert found[1:] == [[], []]


def test_personal_data_columns_equal_plain_ones(spark, docs):
    lines = ["", None, "mail a.b@c.example.org or +49 30 901820", "from 10.0.0.1 and 4111 1111 1111 1111", "é (713) 555-8702 x", "7" * 4000]
    df = spark.createDataFrame([(i, t, "s", 9) for i, t in enumerate(lines)] + [(0, "1.2.3.4", "s", 9), (None, "x", "s", 9)], "doc_id bigint, text string, spans string, n_ip int")
    field = pii.trained()
    got = sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in pii.find(df).collect()), key=str)
    want = []
    for d, t in [*enumerate(lines), (0, "1.2.3.4"), (None, "x")]:
        base = pii.base_spans(t or "")
        every = sorted(base + pii.added_spans(field, [t or ""], [base])[0], key=lambda s: (s[1], pii.KINDS.index(s[0])))
        counts = [sum(s[0] == k for s in base) for k in pii.KINDS]
        want.append((d, *counts, hashlib.sha256(pii.listing(base).encode()).hexdigest(), pii.listing(every)))
    assert got == sorted(want, key=str)
    assert any("phone" in r[-1] and r[4] == 0 for r in got)  # the bracketed number is no base span


def test_field_decodes_the_best_of_all_labellings():
    field = pii.trained()
    step = np.where(field.barred, -1e9, field.steps)
    r = random.Random(3)
    words = ["call", "(713)", "555-8702", "or", "+49", "30", "901820", "a@b", "10.0.0.1", "x"]
    for _ in range(40):
        text = [r.choice(words) for _ in range(r.randint(1, 4))]
        for lo, hi in pii.runs(text):
            score = field.score(text, lo, hi)
            plain = np.stack([field.weights[field._ids(text, at)].sum(axis=0) for at in range(lo, hi)])
            assert np.allclose(score, plain)

            def worth(labels):
                path = [0, *labels, 0]
                return sum(step[a, b] for a, b in zip(path, path[1:])) + sum(score[i, k] for i, k in enumerate(labels))

            best = max(itertools.product(range(len(pii.LABELS)), repeat=hi - lo), key=worth)
            assert worth(best) == pytest.approx(worth(field.decode([score])[0].tolist()))


def test_field_on_lines_held_out():
    found = pii.measured(pii.trained(), pii.made_lines(pii.OTHER_CARRIERS, 600, 7))
    assert all(precision > 0.85 and recall > 0.8 for precision, recall in found.values()), found


def test_exact_dedup_against_a_growing_index(spark, docs, empty):
    name = f"index_{random.getrandbits(60):x}"
    got = by_id(digest_index.deduplicate(docs, name, "one", buckets=4))
    groups = {}
    for d, t, *_ in corpus():
        groups.setdefault(t or "", []).append(d)
    for t, ids in groups.items():
        for d in ids:
            r = got[d]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (max(ids), len(ids), d == max(ids))
            assert r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    later = spark.createDataFrame([(900, "new"), (900, "new"), (901, corpus()[0][1]), (None, "none")], "doc_id bigint, text string")
    again = [(r.doc_id, r.keep_id, r.kept) for r in digest_index.deduplicate(later, name, "two").collect()]
    assert Counter(again) == Counter([(900, 900, True), (900, 900, False), (901, max(groups[corpus()[0][1]]), False), (None, -(2**63), True)])
    assert spark.table(name).count() == len(groups) + 2
    assert digest_index.deduplicate(empty, name, "three").count() == 0
    kept = digest_index.keep_new(later, f"{name}_b", "one")
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(900, "new"), (901, corpus()[0][1]), (0, "none")])


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_batches_through_one_index_decide_like_one(spark, docs, empty, parts):
    groups = {}
    rows = [(d, t) for d, t, *_ in corpus()] + [(None, "only here"), (None, "same words here " * 20), (7, "x"), (7, "x")]
    for d, t in rows:
        groups.setdefault(t or "", []).append(-(2**63) if d is None else d)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    name = f"index_{random.getrandbits(60):x}"
    got = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in digest_index.deduplicate_in_batches(df, name, parts, buckets=4).collect()]
    want = [(d, max(groups[t or ""]), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows]
    assert Counter(got) == Counter(want) and not spark.catalog.tableExists(name)
    assert digest_index.deduplicate_in_batches(empty, name, parts, buckets=4).count() == 0


def test_stages_keep_columns_of_any_name(spark):
    clash = "doc_id bigint, text string, _i string, _s string, _S2 int, _d bigint, _n bigint, _c int, _k int, kept string, source string"
    rows = [(i, prose(i // 2, 30), f"i{i}", "s", 1, 2, 3, 4, 5, "k", "src") for i in range(6)] + [(5, prose(2, 30), "i0", "t", 1, 2, 3, 4, 5, "k", "src")]
    df = spark.createDataFrame(rows, clash)
    once = digest_index.keep_new(df, f"index_{random.getrandbits(60):x}", "one")
    # Of the rows that repeat id and text the one whose columns come last as JSON stays.
    assert sorted(tuple(r) for r in once.collect()) == [rows[1], rows[3], rows[5]]
    assert once.columns == df.columns
    near = near_dup.keep_one(df)
    assert near.columns == df.columns and {r.doc_id for r in near.collect()} == {0, 2, 4}
    mixed = mixing.repeat_copies(df, mixing.mix(df))
    assert mixed.columns == df.columns and {tuple(r) for r in mixed.collect()} <= set(rows)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_token_store_round_trip(spark, docs):
    tokenizer = Tokenizer.from_file(queries.WORD_VOCABULARY)
    more = [(3, "again"), (None, "zz"), (4, "see <|endoftext|> here<|startoftext|>"), (5, "Tail's ends... ok?! a_b- x$$ it's' É!!")]
    repeated = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    folder = scratch(spark, "store")
    token_store.write(repeated, folder, queries.WORD_VOCABULARY)
    keys = token_store.keys_of(repeated).union(spark.createDataFrame([(10**9, 0), (1, 0)], "doc_id bigint, nth bigint"))
    got = {(r.doc_id, r.nth): r for r in token_store.read(keys, folder, with_ids=True).collect()}
    start, seen = 0, Counter()
    rows = [(r.doc_id if r.doc_id is not None else -(2**63), r.text or "") for r in repeated.collect()]
    for d, t in sorted(rows):
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [1]
        r = got[d, seen[d]]
        assert (r.start, r.n_tokens, r.ids) == (start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.asarray(ids, "<u4").tobytes())
        seen[d] += 1
        start += len(ids)
    assert got[10**9, 0].start is None and got[1, 0].start is None


def test_special_tokens_in_a_text_are_those_of_the_library():
    plain = Tokenizer.from_file(queries.WORD_VOCABULARY)
    encoder = token_store.WordEncoder(queries.WORD_VOCABULARY, 1)
    texts = ["see <|endoftext|> here", "a<|startoftext|>b <|ENDOFTEXT|>.", "<|endoftext|><|endoftext|>,x", "< |endoftext|>", "<|endoftext"]
    for t, data in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(data, "<u2").tolist() == plain.encode(t, add_special_tokens=False).ids + [1], t
    assert len(plain.encode(texts[0], add_special_tokens=False).ids) == 3


def test_perfect_hash_is_minimal():
    keys = token_store.key_hash(np.arange(-5000, 5000), np.zeros(10000))
    mph = token_store.PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(10000))


def test_empty_tables_and_the_pipeline(spark, docs, empty, tmp_path):
    assert near_dup.near_duplicates(empty).count() == 0
    assert substring.remove_repeats(empty).count() == 0
    assert merkle.compare_edited(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert pii.find(empty).count() == 0
    assert token_store.read(token_store.keys_of(empty), _store(spark, empty)).count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert extract.extract(pages).count() == 0
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    current = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == current.count() > 0


def _store(spark, df):
    folder = scratch(spark, "store")
    token_store.write(df, folder, queries.WORD_VOCABULARY)
    return folder
