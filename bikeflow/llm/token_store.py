"""Token ids in binary shards with a minimal perfect hash index.

A store is a folder of Spark-made shards in ascending order of the documents' ids:

* ``shard-NNNNN.ids``: the ids of its documents one after the other, little-endian unsigned integers of the
  width in the header of the index (the smallest that holds the vocabulary);
* ``shard-NNNNN.mph``: a minimal perfect hash over its keys, and by slot a 32-bit fingerprint of the key, the
  offset of its first id and the number of its ids.

The hash has levels of bit arrays. A key sits at the first level where no other key shares its bit, and its slot
is the number of bits set before it, so a lookup takes a few probes and one seek however large the shard is. A shard
is written by one task, to a temporary name that is renamed when whole; a repeated task writes the same bytes.
"""

from __future__ import annotations

import json
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow.llm.common import map_batches, texts
from bikeflow.plans.runtime import parallelism

GAMMA = 1.5         # bits per key of a level
CACHED = 300_000    # distinct words whose ids a worker remembers, twice over
SHARD_ROWS = 200_000  # documents of a shard, about; a task holds the keys, offsets and counts of one
MAGIC = b"MPHTOK01"

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def key_hash(ids: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """64 bits for a document's id and the number of earlier rows with that id. One-to-one for ``nth`` 0."""
    with np.errstate(over="ignore"):
        return _mix(ids.astype(np.int64).view(np.uint64) + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (_mix(keys + np.uint64(level + 1) * np.uint64(0xD1342543DE82EF95)) % np.uint64(size)).astype(np.int64)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (_mix(keys ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Slots 0..n-1 for n different keys."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.ranks = []
        total = 0
        for bits in levels:
            upto = np.cumsum(bits, dtype=np.int64)
            self.ranks.append(total + upto - bits)
            total += int(upto[-1]) if len(bits) else 0

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two keys of a shard have the same 64-bit hash")
        levels, left = [], keys
        while len(left):
            size = max(8, int(len(left) * GAMMA))
            at = _at(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 or any slot for a key that was not built in."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = _at(keys[open_], level, len(bits))
            hit = bits[at]
            out[open_[hit]] = self.ranks[level][at[hit]]
            open_ = open_[~hit]
        return out


def pack_index(keys: np.ndarray, offsets: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """The bytes of an index file; a slot's row belongs to the key that hashes there."""
    mph = PerfectHash.build(keys)
    slot = mph.slots(keys)
    rows = np.zeros(len(keys), np.dtype([("fp", "<u4"), ("count", "<u4"), ("offset", "<u8")]))
    rows["fp"][slot], rows["offset"][slot], rows["count"][slot] = fingerprint(keys), offsets, counts
    head = json.dumps({"width": width, "n": len(keys), "levels": [len(x) for x in mph.levels]}).encode()
    parts = [MAGIC, len(head).to_bytes(4, "little"), head, *[np.packbits(x).tobytes() for x in mph.levels], rows.tobytes()]
    return b"".join(parts)


class Index:
    """An index file in memory."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not an index file")
        size = int.from_bytes(data[8:12], "little")
        head, at = json.loads(data[12 : 12 + size]), 12 + size
        levels = []
        for n in head["levels"]:
            raw = np.frombuffer(data, np.uint8, -(-n // 8), at)
            levels.append(np.unpackbits(raw, count=n).astype(bool))
            at += len(raw)
        self.mph = PerfectHash(levels)
        self.rows = np.frombuffer(data, [("fp", "<u4"), ("count", "<u4"), ("offset", "<u8")], head["n"], at)
        self.width = head["width"]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offset and number of ids by key; offset -1 for keys whose fingerprint is not there."""
        if not len(self.rows):
            return np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        slot = self.mph.slots(keys)
        row = self.rows[slot]
        known = (slot >= 0) & (row["fp"] == fingerprint(keys))
        return np.where(known, row["offset"].astype(np.int64), -1), np.where(known, row["count"].astype(np.int64), 0)


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


_LETTERS = _byte_letters()
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # fixed value: ASCII punctuation without the apostrophe
_LATIN_END, _DOTTED = "\u0250", "\u0130"  # below the first, letters are composed and have a small letter each, but for the second


class _Known(dict):
    """Ids by word; a word that is not there is looked up when it is asked for."""

    def __init__(self, make) -> None:
        self.make, self.older = make, {}

    def __missing__(self, word: bytes) -> bytes:
        found = self[word] = self.older.get(word) or self.make(word)
        return found

    def age(self) -> None:
        """Forget the words of the generation before last, if there are many."""
        if len(self) > CACHED:
            self.older = dict(self)
            self.clear()


class WordEncoder:
    """The tokenizers library, asked once for each different word.

    Its steps before the merges never look across ASCII blanks (blanks are dropped, and no character composes with
    one), so the ids of a text are those of its words one after the other. A word of Latin letters, with or without ASCII punctuation
    behind it (no apostrophe, which may begin a contraction), is one run of letters and one of punctuation for these steps; in small
    letters it goes to the library's merges directly, which is several times faster. All others take the whole way. A special token that
    a text spells out is one id, as the library has it: such a token has no blank and is no word of letters, so it goes whole to the library.
    """

    def __init__(self, path: str, end_id: int) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        self.end = self._pack([end_id])
        self.known = _Known(self._ids)
        self.tails: dict[str, bytes] = {"": b""}

    def _pack(self, ids: list[int]) -> bytes:
        packed = array(self.kind, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _whole_way(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _ids(self, word: bytes) -> bytes:
        text = word.decode()
        core = text.rstrip(_TAIL)
        plain = core.isascii()
        if not core.isalpha() or not plain and (max(core) >= _LATIN_END or _DOTTED in core):
            return self._whole_way(text)
        tail = text[len(core) :]
        if tail not in self.tails:
            if len(self.tails) > 1000:
                self.tails = {"": b""}
            self.tails[tail] = self._whole_way(tail)
        core = core.lower()
        if not plain:
            core = "".join(map(_LETTERS.__getitem__, core.encode()))
        return self._pack([t.id for t in self.merges.tokenize(core)]) + self.tails[tail]

    def encode(self, batch: list[str]) -> list[bytes]:
        """Ids of each text with the end id, as bytes of ``width`` per id."""
        self.known.age()
        ids_of = self.known.__getitem__
        return [b"".join(map(ids_of, t.encode().split())) + self.end for t in batch]


@lru_cache(maxsize=2)
def word_encoder(path: str, end_id: int) -> WordEncoder:
    return WordEncoder(path, end_id)


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder.removeprefix('file:')}")


def _put(where: fs.FileSystem, path: str, parts: Iterator[bytes] | list[bytes]) -> None:
    """Write under a name of this attempt, then rename: a reader never sees half a file."""
    context = TaskContext.get()
    own = f"{path}.{context.taskAttemptId() if context else 'driver'}"
    with where.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    where.move(own, path)


def write(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode ``docs`` into a store at ``folder`` and return its manifest, a row per shard.

    The manifest (``shard``, ``n_docs``, ``n_ids``, ``low``, ``high``, ``start``) is also left in the folder as
    ``manifest.json``; it has a row per ``SHARD_ROWS`` documents, one per shuffle partition at least. Ids are sampled only to find the ranges. A null text is empty and holds
    the end id alone. Rows that repeat an id follow each other in the order of their texts and have the
    keys (id, 0), (id, 1), ...; a null id counts as the smallest bigint. An empty input gives empty shards.
    """
    spark = docs.sparkSession
    where, base = _open(folder)
    where.create_dir(base, recursive=True)
    keyed = texts(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"), "text")
    shards = max(parallelism(spark), -(-docs.count() // SHARD_ROWS))
    ordered = keyed.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")

    def work(batches):
        encoder = word_encoder(tokenizer_path, end_id)
        shard = TaskContext.get().partitionId()
        out_fs, at = _open(folder)
        ids, counts = [], []

        def payload():
            for b in batches:
                for lo in range(0, len(b["text"]), 256):
                    for doc, data in zip(b["doc_id"][lo : lo + 256], encoder.encode(b["text"][lo : lo + 256]), strict=True):
                        ids.append(doc)
                        counts.append(len(data) // encoder.width)
                        yield data

        _put(out_fs, f"{at}/shard-{shard:05d}.ids", payload())
        doc, n = np.asarray(ids, np.int64), np.asarray(counts, np.int64)
        first = np.r_[True, doc[1:] != doc[:-1]] if len(doc) else np.zeros(0, bool)
        run = np.arange(len(doc)) - np.maximum.accumulate(np.where(first, np.arange(len(doc)), 0))
        keys = key_hash(doc, run)
        _put(out_fs, f"{at}/shard-{shard:05d}.mph", [pack_index(keys, np.cumsum(n) - n, n, encoder.width)])
        yield {
            "shard": [shard], "n_docs": [len(doc)], "n_ids": [int(n.sum())],
            "low": [int(doc[0]) if len(doc) else None], "high": [int(doc[-1]) if len(doc) else None],
        }

    written = map_batches(ordered, work, "shard int, n_docs bigint, n_ids bigint, low bigint, high bigint")
    rows = sorted((r.asDict() for r in written.collect()), key=lambda r: r["shard"])  # one row per partition
    start = 0
    for r in rows:
        r["start"] = start
        start += r["n_ids"]
    _put(where, f"{base}/manifest.json", [json.dumps(rows).encode()])
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    where, base = _open(folder)
    with where.open_input_stream(f"{base}/manifest.json") as f:
        rows = json.loads(f.read())
    schema = "shard int, n_docs bigint, n_ids bigint, low bigint, high bigint, start bigint"
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)


def read(keys: DataFrame, folder: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Look ``keys`` up in the store: ``doc_id``, ``nth``, ``start``, ``n_tokens``, ``ids_crc32`` and with ``with_ids`` the ``ids``.

    ``start`` is the number of ids of all documents before it in the store. ``keys`` may have a column ``nth`` for rows
    that repeat an id (0 without it). A key that is not in the store has null in all other columns, but for one in 2**32 that shares a fingerprint.
    """
    spark = keys.sparkSession
    where, base = _open(folder)
    with where.open_input_stream(f"{base}/manifest.json") as f:
        shards = [r for r in json.loads(f.read()) if r["n_docs"]]
    lows = np.asarray([r["low"] for r in shards], np.int64)
    numbers = [r["shard"] for r in shards]
    starts = {r["shard"]: r["start"] for r in shards}
    nth = F.col("nth").cast("bigint") if "nth" in keys.columns else F.lit(0).cast("bigint")
    wanted = keys.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63))).alias("doc_id"), nth.alias("nth"))

    def route(batches):
        for b in batches:
            at = np.searchsorted(lows, np.asarray(b["doc_id"], np.int64), "right") - 1
            yield {**b, "shard": [numbers[i] if i >= 0 else -1 for i in at]}

    def work(batches):
        in_fs, at = _open(folder)
        held, index, file = None, None, None
        for b in batches:
            ids, which = np.asarray(b["doc_id"], np.int64), np.asarray(b["shard"])
            keys_ = key_hash(ids, np.asarray(b["nth"], np.int64))
            cuts = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
            out = {c: [] for c in ("doc_id", "nth", "start", "n_tokens", "ids_crc32", "ids")}
            for lo, hi in zip(cuts, [*cuts[1:], len(which)], strict=True):
                shard = int(which[lo])
                if shard != held and shard >= 0:
                    with in_fs.open_input_stream(f"{at}/shard-{shard:05d}.mph") as f:
                        index = Index(f.read())
                    file = in_fs.open_input_file(f"{at}/shard-{shard:05d}.ids")
                    held = shard
                offsets, counts = index.find(keys_[lo:hi]) if shard >= 0 else (np.full(hi - lo, -1), np.zeros(hi - lo))
                for i, offset, n in zip(range(lo, hi), offsets.tolist(), counts.tolist(), strict=True):
                    out["doc_id"].append(b["doc_id"][i])
                    out["nth"].append(b["nth"][i])
                    if offset < 0:
                        for c in ("start", "n_tokens", "ids_crc32", "ids"):
                            out[c].append(None)
                        continue
                    raw = file.read_at(n * index.width, offset * index.width)
                    wide = np.frombuffer(raw, f"<u{index.width}").astype("<u4")
                    out["start"].append(starts[shard] + offset)
                    out["n_tokens"].append(n)
                    out["ids_crc32"].append(zlib.crc32(wide.tobytes()))
                    out["ids"].append(wide if with_ids else None)
            yield out

    schema = "doc_id bigint, nth bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids array<bigint>"
    routed = map_batches(wanted, route, "doc_id bigint, nth bigint, shard int")
    # One shard's keys next to each other, so that a task opens each index once. Keys of one shard may be many: they
    # are spread by id as well, over as many tasks as there are.
    near = routed.repartitionByRange(parallelism(spark), "shard", "doc_id").sortWithinPartitions("shard", "doc_id", "nth")
    found = map_batches(near, work, schema)
    return found if with_ids else found.drop("ids")


def keys_of(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``doc_id``, ``nth``: the keys under which ``write`` stores the rows of ``docs``."""
    counted = docs.groupBy(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63))).alias("doc_id")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return counted.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("nth"))
