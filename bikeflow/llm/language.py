"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of up to three bytes with the counts of the bytes that followed. A byte is coded in the
longest context that was seen with it; each context that does not know it costs an escape (method C: with n symbols and
d different ones seen, a byte seen c times has probability c / (n + d), the escape d / (n + d)); below the empty context all 256 bytes are
equally likely. Statistics are frozen after training, so the code length of a byte depends only on the three bytes before it,
and is found for all languages at once. A text belongs to the language that codes it shortest.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bikeflow.llm.common import map_batches

ORDER = 3
START = b"\n" * ORDER
UNKNOWN = "und"
CHUNK = 1 << 18  # bytes scored at once with up to eight languages


class Model:
    """Code lengths in bits, by context of none to three bytes.

    ``grams`` has for each language its four-byte grams (as big-endian integers) and their counts. Only what was seen is stored:
    for a context the languages that know it with their escapes, for a byte after it the languages that saw it there with its length. So
    the model grows with the grams, not with symbols times languages, and no context is left out.
    """

    def __init__(self, grams: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.languages = sorted(grams)
        parts = [grams[lang] for lang in self.languages]
        gram = np.concatenate([np.zeros(0, np.int64), *[g for g, _ in parts]])
        count = np.concatenate([np.zeros(0), *[n for _, n in parts]])
        lang = np.repeat(np.arange(len(parts)), [len(g) for g, _ in parts])
        n_langs = max(len(parts), 1)
        seen = np.unique(np.r_[10, *[(gram >> s) & 255 for s in (0, 8, 16, 24)]])
        self.symbol = np.full(256, len(seen), np.int64)  # one more for all bytes that were never seen
        self.symbol[seen] = np.arange(len(seen))
        self.n_symbols = a = len(seen) + 1
        full = self._key(self.symbol[(gram >> s) & 255] for s in (24, 16, 8, 0))

        self.orders = []
        for order in range(ORDER + 1):
            # A cell is a byte after a context in a language; a stay is a context in a language.
            cell, where = np.unique(full % a ** (order + 1) * n_langs + lang, return_inverse=True)
            times = np.bincount(where, count, len(cell))
            stay, where = np.unique(cell // n_langs // a * n_langs + cell % n_langs, return_inverse=True)
            n, d = np.bincount(where, times, len(stay)), np.bincount(where, minlength=len(stay))
            escape = np.log2(n + d) - np.log2(np.maximum(d, 1))
            length = np.log2(n + d)[where] - np.log2(times)
            self.orders.append((self._rows(stay, escape, n_langs), self._rows(cell, length, n_langs)))

    def _key(self, symbols) -> np.ndarray:
        """One number for the symbols of a context and the one after it."""
        out = np.int64(0)
        for s in symbols:
            out = out * self.n_symbols + s
        return out

    @staticmethod
    def _rows(key: np.ndarray, value: np.ndarray, n_langs: int) -> tuple[np.ndarray, ...]:
        """Values by key and language as sorted keys, where the rows of each start, languages and values."""
        own, start = np.unique(key // n_langs, return_index=True)
        return own, np.r_[start, len(key)], (key % n_langs).astype(np.int32), value.astype(np.float32)

    @staticmethod
    def _find(rows: tuple[np.ndarray, ...], key: np.ndarray) -> tuple[np.ndarray, ...]:
        """Which of the keys are in the rows, in which language and with which value; a key has a place per language."""
        own, start, lang, value = rows
        if not len(own):
            return np.zeros(0, np.int64), lang, value
        at = np.minimum(np.searchsorted(own, key), len(own) - 1)
        hit = np.flatnonzero(own[at] == key)
        lo, size = start[at[hit]], start[at[hit] + 1] - start[at[hit]]
        place = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.repeat(hit, size), lang[place], value[place]

    def lengths(self, key: np.ndarray) -> np.ndarray:
        """The code length in each language of the last of four symbols, after the other three."""
        out = np.full((len(key), max(len(self.languages), 1)), 8.0, np.float32)  # no context, all bytes alike
        a = self.n_symbols
        for order, (escapes, cells) in enumerate(self.orders):
            own = key % a ** (order + 1)
            # A language that never saw the context codes in the shorter one, at no cost.
            at, lang, bits = self._find(escapes, own // a)
            out[at, lang] += bits
            at, lang, bits = self._find(cells, own)
            out[at, lang] = bits
        return out

    @property
    def cost(self) -> np.ndarray:
        """All code lengths as one table, a row for each symbol after each known context, shorter ones after unknown symbols."""
        a = self.n_symbols
        contexts = [(a**ORDER - a**order) + escapes[0] for order, (escapes, _) in enumerate(self.orders)]
        return self.lengths((np.concatenate(contexts)[:, None] * a + np.arange(a)).ravel())

    def bits(self, text: bytes) -> np.ndarray:
        """The code length of the text in each language."""
        return self.bits_of([text])[0]

    def bits_of(self, texts: list[bytes]) -> np.ndarray:
        """The code length of each text in each language, a row per text."""
        chunk = max(CHUNK * 8 // max(len(self.languages), 8), 4096)  # as many numbers with many languages
        total = np.zeros((len(texts), max(len(self.languages), 1)))
        group, size = [], 0

        def score() -> None:
            raw = np.frombuffer(b"".join(piece for _, piece in group), np.uint8)
            s = self.symbol[raw]
            key = self._key((s[:-3], s[1:-2], s[2:-1], s[3:]))
            n = np.array([len(piece) - ORDER for _, piece in group])
            # Grams across two pieces are none of a text.
            inside = np.repeat(np.cumsum(n + ORDER) - (n + ORDER) - (np.cumsum(n) - n), n) + np.arange(n.sum())
            grams, where = np.unique(key[inside], return_inverse=True)
            per_byte = self.lengths(grams)[where]
            sums = np.add.reduceat(per_byte, np.cumsum(n) - n, axis=0, dtype=np.float64)
            np.add.at(total, [i for i, _ in group], sums)

        for i, text in enumerate(texts):
            for lo in range(0, len(text), chunk):
                before = (START + text[max(lo - ORDER, 0) : lo])[-ORDER:]
                group.append((i, before + text[lo : lo + chunk]))
                size += len(group[-1][1])
                if size >= chunk:
                    score()
                    group, size = [], 0
        if group:
            score()
        return total

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """For each text the language and its share of the probability that all languages give the text."""
        out = [(UNKNOWN, 0.0)] * len(texts)
        known = [i for i, t in enumerate(texts) if self.languages and t is not None and next(filter(str.isalpha, t), None) is not None]
        for i, bits in zip(known, self.bits_of([texts[i].encode() for i in known]), strict=True):
            best = int(bits.argmin())
            out[i] = self.languages[best], float(1.0 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum())
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether a document is kept from training: CRC-32 of its id as text, modulo ``folds``, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(False))


def train(
    docs: DataFrame, docs_per_language: int = 500, folds: int = 5,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Model:
    """A model of the languages in ``lang_col``.

    It learns from about ``docs_per_language`` documents of each, drawn by a hash of the id from all rows that are
    labelled, have a text and are not ``held_out``. Their four-byte grams are counted in the tasks; all of them make the model,
    whose size is thus bounded by that sample at any size of the input. Rows that repeat an id are drawn or left together, a null
    id is never drawn; without a usable row the model has no languages.
    """
    usable = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id", folds))
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per language
    share = F.lit(0.0)
    for r in sizes:
        share = F.when(F.col("lang") == r.lang, F.lit(min(1.0, docs_per_language / r.n))).otherwise(share)
    drawn = usable.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("train")), F.lit(1_000_000)) < share * 1_000_000)

    def count(batches):
        for b in batches:
            by_lang = defaultdict(list)
            for lang, text in zip(b["lang"], b["text"], strict=True):
                raw = np.frombuffer(START + text.encode(), np.uint8).astype(np.int64)
                by_lang[lang].append((raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:])
            for lang, grams in by_lang.items():
                gram, n = np.unique(np.concatenate(grams), return_counts=True)
                yield {"lang": [lang] * len(gram), "gram": gram, "n": n}

    counted = map_batches(drawn.select("lang", "text"), count, "lang string, gram bigint, n bigint")
    total = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = total.orderBy("lang", "gram").toArrow().to_pandas()
    return Model({k: (g["gram"].to_numpy(), g["n"].to_numpy(float)) for k, g in found.groupby("lang")})


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", folds: int = 5) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``: one row per input row, from its whole text alone.

    ``und`` and score 0 for a null text, one without a letter, or a model without languages. The score is the language's share of the
    probability (0 to 1); of equal code lengths the first language in code point order wins.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the grams of the model
    picked = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        held_out(id_col, folds).alias("held_out"),
    )

    def work(batches):
        for b in batches:
            found = shared.value.predict_all(b["text"])
            yield {"doc_id": b["doc_id"], "held_out": b["held_out"], "lang_pred": [x[0] for x in found], "score": [x[1] for x in found]}

    return map_batches(picked, work, "doc_id bigint, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, min_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without rows whose text is ``und`` or whose language has a score below ``min_score``; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def work(batches):
        for b in batches:
            found = shared.value.predict_all(b[text_col])
            good = [i for i, (lang, score) in enumerate(found) if lang != UNKNOWN and score >= min_score]
            yield {c: [v[i] for i in good] for c, v in b.items()}

    return map_batches(docs, work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema))
