"""Byte-level BPE as a reduction over a tree.

A text is halved until its pieces are short. A piece is encoded by itself, and two encoded neighbours are
joined: the window around the cut is encoded anew and replaces the tokens it covers. A place where a non-blank
is followed by a blank starts a new match of the pattern whatever stands around it (no
alternative goes on from a non-blank to a blank, none looks back, and what ends there has looked no further than the
blank). So tokens left of the last such place before the cut and right of the first
one behind it are the tokens of the whole text, and the window only grows until it meets these places or the ends.
Decoding concatenates the bytes of the halves up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache
from pathlib import Path

import tiktoken
from pyspark.sql import DataFrame

from bikeflow.llm.common import row_wise, texts

LEAF = 256  # code points that are encoded in one go; nearly all texts have several

# Blanks as the pattern's \s sees them; Python's own \s has four control characters more.
BLANK = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
EDGE = re.compile(rf"(?<=[^{BLANK}])[{BLANK}]")


class Codec:
    """Encoder and decoder for a file of ranks and the pattern that splits text before the merges."""

    def __init__(self, ranks_path: str, pattern: str, leaf: int = LEAF) -> None:
        ranks = {}
        for line in Path(ranks_path).read_bytes().splitlines():
            if line:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.leaf = leaf
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self._short = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def encode(self, text: str) -> list[int]:
        """Token ids of the whole text; the empty text has none."""
        if len(text) <= self.leaf:
            return self._short(text)
        return self._tree(text, 0, len(text))

    def _tree(self, text: str, start: int, end: int) -> list[int]:
        if end - start <= self.leaf:
            return self._short(text[start:end])
        middle = (start + end) // 2
        return self._join(
            text, start, middle, end, self._tree(text, start, middle), self._tree(text, middle, end)
        )

    def _join(self, text: str, start: int, middle: int, end: int, left: list[int], right: list[int]) -> list[int]:
        """Ids of ``text[start:end]`` from those of its two parts. Changes ``left``."""
        a = self._edge_before(text, start, middle)
        found = EDGE.search(text, middle + 1, end) if middle + 1 < end else None
        b = found.start() if found else end
        keep = len(left)
        over = len(text[a:middle].encode())
        while over > 0:
            keep -= 1
            over -= len(self.bytes_of[left[keep]])
        skip, over = 0, len(text[middle:b].encode())
        while over > 0:
            over -= len(self.bytes_of[right[skip]])
            skip += 1
        del left[keep:]
        left += self._short(text[a:b])
        left += right[skip:] if skip else right
        return left

    @staticmethod
    def _edge_before(text: str, start: int, middle: int) -> int:
        """The last place in ``text[start:middle]`` where a blank follows a non-blank, else ``start``."""
        width = 64
        while True:
            at = max(start, middle - width)
            last = None
            for last in EDGE.finditer(text, at, middle):
                pass
            if last is not None and last.start() > start:
                return last.start()
            if at == start:
                return start
            width *= 4

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the ids, halves first."""
        if len(ids) <= 4 * self.leaf:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str, leaf: int = LEAF) -> Codec:
    """One codec per worker process and file."""
    return Codec(ranks_path, pattern, leaf)


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas), ``decoded_sha256``.

    One row per input row, repeated ids included. A null text is the empty text, which has no tokens. A text
    of any length stays in its row; one without blanks is encoded as a single window.
    """

    def digest(doc_id, text):
        c = codec(ranks_path, pattern, leaf)
        ids = c.encode(text)
        joined = ",".join(map(c.decimal.__getitem__, ids)).encode()
        return doc_id, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest()

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return row_wise(texts(docs, id_col, text_col), digest, ["doc_id", "text"], schema)


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF
) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) per input row; a null text has an empty array."""

    def ids_of(doc_id, text):
        return doc_id, codec(ranks_path, pattern, leaf).encode(text)

    return row_wise(texts(docs, id_col, text_col), ids_of, ["doc_id", "text"], "doc_id bigint, ids array<int>")


def decode(
    encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids", leaf: int = LEAF
) -> DataFrame:
    """``doc_id``, ``bytes`` per input row; null ids give no bytes. An unknown id raises ``IndexError``."""

    def bytes_of(doc_id, ids):
        return doc_id, codec(ranks_path, pattern, leaf).decode(ids or [])

    picked = encoded.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{ids_col}` as ids")
    return row_wise(picked, bytes_of, ["doc_id", "ids"], "doc_id bigint, bytes binary")
