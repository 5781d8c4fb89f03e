"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences.

Paragraphs are lines, sentences end at a full stop, exclamation or question mark and a blank; a long sentence without one is cut after words
chosen by their hash. A section ends after a paragraph chosen by its digest. All cuts depend only on the text around
them, so an edit changes the nodes above it and no others. The fingerprint holds the root (128 bits, equal exactly for
equal texts) and the shortened digests of all nodes below:

``root/section(paragraph:sentence sentence...,paragraph:...)...`` in hex, 8 digits for sections and
paragraphs, 6 for sentences.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikeflow.llm.common import map_batches, texts
from bikeflow.plans.runtime import parallelism

SENTENCE = re.compile(r"(?<=[.!?] )")
LONG = 160          # code points; longer sentences are cut again
EVERY = 8           # words in a piece of a long sentence, on average
SECTION = 64        # of 256 paragraph digests, those that end a section


def _node(kind: bytes, parts: bytes) -> bytes:
    return hashlib.blake2b(kind + parts, digest_size=16).digest()


def _pieces(paragraph: str) -> list[str]:
    out = []
    for sentence in SENTENCE.split(paragraph):
        if len(sentence) <= LONG:
            out.append(sentence)
            continue
        piece = []
        for word in sentence.split(" "):
            piece.append(word)
            if zlib.crc32(word.encode()) % EVERY == 0:
                out.append(" ".join(piece) + " ")
                piece = []
        out.append(" ".join(piece))
    return out


def fingerprint(text: str | None) -> str:
    """The tree of a text as a string; null is the empty text."""
    sections, paragraphs, whole = [], [], []

    def close() -> None:
        digest = _node(b"s", b"".join(d for d, _ in paragraphs))
        whole.append(digest)
        inner = ",".join(f"{d[:4].hex()}:{leaves}" for d, leaves in paragraphs)
        sections.append(f"{digest[:4].hex()}({inner})")
        paragraphs.clear()

    for line in (text or "").split("\n"):
        leaves = [_node(b"l", p.encode()) for p in _pieces(line)]
        digest = _node(b"p", b"".join(leaves))
        paragraphs.append((digest, "".join(x[:3].hex() for x in leaves)))
        if digest[0] < SECTION:
            close()
    if paragraphs:
        close()
    return _node(b"r", b"".join(whole)).hex() + "/" + "".join(sections)


def parse(mark: str) -> list[tuple[str, list[tuple[str, list[str]]]]]:
    """Sections, their paragraphs and the sentences of those, by digest."""
    out = []
    for section in mark.partition("/")[2].split(")")[:-1]:
        digest, _, inner = section.partition("(")
        lines = [p.partition(":") for p in inner.split(",")]
        out.append((digest, [(d, [s[i : i + 6] for i in range(0, len(s), 6)]) for d, _, s in lines]))
    return out


def _unmatched(a: list[tuple], b: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Nodes of either side beyond those with an equal digest on the other side."""
    both = Counter(x[0] for x in a) & Counter(x[0] for x in b)
    rest = []
    for side in (a, b):
        left, mine = Counter(both), []
        for x in side:
            if left[x[0]] > 0:
                left[x[0]] -= 1
            else:
                mine.append(x)
        rest.append(mine)
    return rest[0], rest[1]


def likeness(a: str, b: str) -> float:
    """Share of the sentences of both that lie under equal nodes, 0 to 1; 1 for equal roots only.

    Equal sections are not looked into, then equal paragraphs of the other sections, then sentences.
    """
    if a[:32] == b[:32]:
        return 1.0
    left, right = parse(a), parse(b)
    total = sum(len(s) for side in (left, right) for _, ps in side for _, s in ps)
    left, right = _unmatched(left, right)
    left, right = _unmatched([p for _, ps in left for p in ps], [p for _, ps in right for p in ps])
    left, right = _unmatched([(s,) for _, ss in left for s in ss], [(s,) for _, ss in right for s in ss])
    same = total - len(left) - len(right)
    return min(same / total, 1 - 1e-9)


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """Where ``a`` differs from ``b``: (section, paragraph) positions in ``a`` of branches that ``b`` lacks."""
    if a[:32] == b[:32]:
        return []
    there = Counter(s for s, _ in parse(b))
    lines = {p for _, ps in parse(b) for p, _ in ps}
    return [
        (i, j) for i, (s, ps) in enumerate(parse(a)) if s not in there for j, (p, _) in enumerate(ps) if p not in lines
    ]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_chars``, ``fingerprint`` per input row; a null text counts as empty."""

    def work(batches):
        for b in batches:
            yield {
                "doc_id": b["doc_id"], "n_chars": [len(t) for t in b["text"]], "fingerprint": [fingerprint(t) for t in b["text"]],
            }

    return map_batches(texts(docs, id_col, text_col), work, "doc_id bigint, n_chars bigint, fingerprint string")


def _with_neighbours(docs: DataFrame) -> DataFrame:
    """``docs`` (``ord``, ``text``) in blocks of descending ``ord``, each block followed by the row after it as a ``guest``.

    Blocks are ranges of ids between quantiles, one per shuffle partition. Only the texts' own shuffle is needed: the
    one row that a block needs of the next is sent to both.
    """
    spark = docs.sparkSession
    n = parallelism(spark)
    bounds = docs.select("ord").agg(F.percentile_approx("ord", [i / n for i in range(1, n)] or [0.5], F.lit(10_000))).first()[0]
    bounds = sorted(set(bounds or []))

    def block_of(column):
        # Two steps of about the square root of the number of bounds.
        step = max(1, int(len(bounds) ** 0.5))
        out = F.lit(0)
        for lo in range(0, len(bounds), step):
            part = bounds[lo : lo + step]
            inside = F.lit(lo)
            for x in part:
                inside = inside + (column > F.lit(x)).cast("int")
            out = F.when(column > F.lit(part[0]), inside).otherwise(out) if lo else inside
        return out.cast("int")

    blocked = docs.withColumn("block", block_of(F.col("ord")))
    tops = sorted((r.block, r.top) for r in blocked.groupBy("block").agg(F.max("ord").alias("top")).collect())
    goes = spark.createDataFrame(
        [(top, tops[(i + 1) % len(tops)][0]) for i, (_, top) in enumerate(tops)], "_top bigint, _to int"
    )
    guests = (
        docs.filter(F.col("ord").isin([top for _, top in tops]))
        .join(F.broadcast(goes), F.col("ord") == F.col("_top"))  # one row per block
        .select(*docs.columns, F.col("_to").alias("block"), F.lit(1).alias("guest"))
    )
    every = blocked.withColumn("guest", F.lit(0)).unionByName(guests)
    return every.repartitionById(n, "block").sortWithinPartitions("block", "guest", F.col("ord").desc(), "text")


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of an edited copy, and how alike they and the next document's are.

    The edited copy has its last ``n_chars // 3`` code points replaced by the first as many (or all) of the
    next document, in descending order of id; after the last comes the first. A null text is empty, and two empty
    texts are equal (likeness 1). A single document is its own next. Rows that repeat an id follow each other by text; a null id comes last.
    """
    plain = texts(docs, id_col, text_col).withColumn("ord", F.coalesce("doc_id", F.lit(-(2**63))))
    placed = _with_neighbours(plain)

    def rows(batches):
        for b in batches:
            yield from zip(b["block"], b["guest"], b["doc_id"], b["text"], strict=True)

    def work(batches):
        out, held = [], None
        for block, guest, doc, text in rows(batches):
            mark = None
            if held and held[0] == block:
                mark = fingerprint(text)
                _, own_doc, own, own_mark = held
                k = len(own) // 3
                edited = own[: len(own) - k] + text[:k]
                edited_mark = fingerprint(edited)
                sha = hashlib.sha256(edited.encode()).hexdigest()
                out.append((own_doc, len(own), sha, own_mark, edited_mark, likeness(own_mark, edited_mark), likeness(own_mark, mark)))
            held = None if guest else (block, doc, text, mark or fingerprint(text))
            if len(out) >= 512:
                yield dict(zip(names, map(list, zip(*out, strict=True)), strict=True))
                out = []
        if out:
            yield dict(zip(names, map(list, zip(*out, strict=True)), strict=True))

    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    return map_batches(placed.select("block", "guest", "doc_id", "text"), work, schema)
