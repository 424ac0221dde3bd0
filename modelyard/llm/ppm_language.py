"""Language identification by prediction by partial matching.

One byte context tree per language, orders 2, 1 and 0, with method C escapes
and exclusion.  The statistics are counts over all training texts and stay
frozen while texts are scored, so the code length of a byte depends on the two
bytes before it only and a text's code length is a sum over its byte triples.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_text, text_slices

PAD = b"\x00\x00"          # stands before the first byte of every text
UNKNOWN = "und"
HELD = 1_000_000           # triples a task holds, all languages together, before it sums them


def triples(text: str) -> np.ndarray:
    """Every byte of the text with the two before it, as 24-bit numbers."""
    b = np.frombuffer(PAD + text.encode("utf-8", "replace"), dtype=np.uint8).astype(np.int32)
    return (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]


def count_triples(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``(lang, triple, n)`` over all given rows; each task sums its own first."""
    def run(batches):
        import pyarrow as pa
        sums: dict[str, np.ndarray] = {}
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def fold(lang):
            keys, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
            was = sums.get(lang)
            if was is not None:
                both = np.concatenate([was[0], keys])
                keys, at = np.unique(both, return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([was[1], n])).astype(np.int64)
            sums[lang] = (keys, n)

        for whole in batches:
            for b in text_slices(whole, "t"):
                for lang, text in zip(b.column("l").to_pylist(), b.column("t").to_pylist()):
                    if text:
                        t = triples(text)
                        held.setdefault(lang, []).append(t)
                        size += len(t)
                        if size > HELD:
                            for name in list(held):
                                fold(name)
                            size = 0
        for lang in list(held):
            fold(lang)
        for lang, (keys, n) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int32)),
                 pa.array(n.astype(np.int64))], names=["lang", "triple", "n"])

    return (df.where(F.col(lang_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("l"), F.col(text_col).alias("t"))
            .mapInArrow(run, "lang string, triple int, n long")
            .groupBy("lang", "triple").agg(F.sum("n").alias("n")))


class LanguageTree:
    """Frozen PPM statistics of one language and the code length of a triple."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys, order = np.unique(keys, return_index=True)
        self.n = n[order].astype(np.float64)
        ctx2, pair, sym, ctx1 = (self.keys >> 8, self.keys & 0xFFFF, self.keys & 0xFF,
                                 (self.keys >> 8) & 0xFF)
        self.n2 = np.bincount(ctx2, self.n, 65536)
        self.t2 = np.bincount(ctx2, minlength=65536).astype(np.float64)
        self.c1 = np.bincount(pair, self.n, 65536)
        c1 = self.c1.reshape(256, 256)
        self.n1, self.t1 = c1.sum(1), (c1 > 0).sum(1).astype(np.float64)
        self.c0 = c1.sum(0)
        self.n0, self.t0 = self.c0.sum(), float((self.c0 > 0).sum())
        # Mass and number of lower-order symbols excluded after an escape.
        self.out1 = np.bincount(ctx2, self.c1[pair], 65536)
        self.out0 = ((c1 > 0) * self.c0).sum(1)
        del ctx1, sym

    def bits(self, triple: np.ndarray) -> np.ndarray:
        """Exact code length of the last byte after the two before it."""
        at = np.minimum(np.searchsorted(self.keys, triple), max(len(self.keys) - 1, 0))
        seen2 = (self.keys[at] == triple) if len(self.keys) else np.zeros(len(triple), bool)
        n2 = np.where(seen2, self.n[at] if len(self.keys) else 0.0, 0.0)
        ctx2, pair, ctx1, sym = (triple >> 8, triple & 0xFFFF, (triple >> 8) & 0xFF, triple & 0xFF)
        p = np.ones(len(triple))
        todo = np.ones(len(triple), bool)

        def level(seen, c, total, kinds):
            # A context without symbols left escapes at no cost.
            nonlocal p, todo
            room = total + kinds
            safe = np.where(room > 0, room, 1.0)
            here = todo & seen
            p = np.where(here, p * c / safe, p)
            todo = todo & ~seen
            p = np.where(todo & (room > 0), p * kinds / safe, p)

        level(seen2, n2, self.n2[ctx2], self.t2[ctx2])
        c1 = self.c1[pair]
        level(c1 > 0, c1, self.n1[ctx1] - self.out1[ctx2], self.t1[ctx1] - self.t2[ctx2])
        c0 = self.c0[sym]
        level(c0 > 0, c0, self.n0 - self.out0[ctx1], self.t0 - self.t1[ctx1])
        p = np.where(todo, p / max(256.0 - self.t0, 1.0), p)
        return -np.log2(np.maximum(p, 1e-300))


class Scorer:
    """Code lengths of texts under all languages at once."""

    def __init__(self, langs: list[str], tables: list[tuple[np.ndarray, np.ndarray]]):
        self.langs = langs
        self.trees = [LanguageTree(k, n) for k, n in tables]
        self.known = (np.unique(np.concatenate([k for k, _ in tables])) if tables
                      else np.empty(0, np.int64)).astype(np.int64)
        self.cost = (np.stack([t.bits(self.known) for t in self.trees], 1) if tables
                     else np.empty((0, 0)))
        # A page of rows for each known pair of bytes, by the byte after it; page 0 is empty.
        pairs = np.unique(self.known >> 8)
        self.page = np.zeros(1 << 16, np.int32)
        self.page[pairs] = np.arange(1, len(pairs) + 1, dtype=np.int32)
        self.row = np.full((len(pairs) + 1) << 8, -1, np.int32)
        self.row[self._place(self.known)] = np.arange(len(self.known), dtype=np.int32)

    def _place(self, triple: np.ndarray) -> np.ndarray:
        return (self.page[triple >> 8] << 8) | (triple & 0xFF).astype(np.int32)

    def lengths(self, text: str) -> np.ndarray:
        t = triples(text)
        at = self.row[self._place(t)]
        new = at < 0
        if new.any():
            total = np.array([tree.bits(t[new].astype(np.int64)).sum() for tree in self.trees])
            at = at[~new]
        else:
            total = np.zeros(len(self.trees))
        if len(at) > len(self.known):
            return total + np.bincount(at, minlength=len(self.known)) @ self.cost
        return total + self.cost[at].sum(0)


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple:
    """Counts of all rows with a language, gathered per language.

    The result has at most 2^24 triples a language whatever the input's size
    (a byte triple has no more values); the driver holds these arrays.
    """
    rows = count_triples(df, text_col, lang_col).toPandas()
    langs = sorted(rows["lang"].unique())
    tables = []
    for lang in langs:
        part = rows[rows["lang"] == lang]
        tables.append((part["triple"].to_numpy(np.int64), part["n"].to_numpy(np.int64)))
    return langs, tables


def predict(df: DataFrame, model: tuple, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row.

    ``score`` is the posterior of the chosen language under equal priors.  A
    text that is null, empty or without a letter, and any text when nothing
    was learned, is ``und`` with score 0.  Ties go to the first name.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        langs, tables = shared.value
        scorer = Scorer(langs, tables)

        def fn(texts):
            names, scores = [], []
            for t in texts:
                if not langs or not t or not any(map(str.isalpha, t)):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                bits = scorer.lengths(t)
                best = int(bits.argmin())
                names.append(langs[best])
                scores.append(float(1.0 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum()))
            return [names, scores]
        return fn

    return map_text(df, make, [T.StructField("lang_pred", T.StringType()),
                               T.StructField("score", T.DoubleType())], text_col)
