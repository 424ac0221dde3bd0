"""Toxicity by class-conditional Kneser-Ney language models.

Two word models, of toxic and of ordinary texts: bigram counts of the class,
then unigram counts of the class, then continuation counts that both classes
share, each discounted.  A text's score is the difference of the two
log-likelihoods per word, turned into a probability on training rows that the
models have not counted.
"""

from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_text, text_slices
from .graph import written
from .phrases import _packed, _unpacked
from .tokens import TokenIds

DISCOUNT = 0.75
# A word or pair in fewer texts is a rare expression: it has no counts of its
# own, only what all rare ones share.  The held training rows decide which of
# these limits holds, and whether bigrams help.
RARE_BELOW = (10, 40, 160, 640, 2560)
# So below the least limit no setting reads a count, and the tables that score
# texts need not hold it: they score as tables of all words and pairs would.
LEAST = min(RARE_BELOW)
# Ids that no word has.
RARE = np.uint32(0)
START = np.uint32(1)


def _class_counts(rows: DataFrame) -> DataFrame:
    """``(key, toxic, ordinary)``: texts of each class that hold the word or pair.

    A text counts once for a key however often it repeats it, so one text that
    repeats a word doesn't make the word a mark of its class.  Each task sums
    first.
    """
    def run(batches):
        tokens = TokenIds(lower=True)
        held, size, sums = {0: [], 1: []}, 0, None

        def fold():
            nonlocal sums, held, size
            parts = [] if sums is None else [sums]
            for label in (0, 1):
                if held[label]:
                    k, n = np.unique(np.concatenate(held[label]), return_counts=True)
                    both = np.zeros((2, len(k)), np.int64)
                    both[label] = n
                    parts.append((k, both))
            if len(parts) > 1:
                k, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.concatenate([p[1] for p in parts], 1)
                sums = (k, np.stack([np.bincount(at, n[i], len(k)).astype(np.int64)
                                     for i in (0, 1)]))
            elif parts:
                sums = parts[0]
            held, size = {0: [], 1: []}, 0

        def rows_out():
            k, n = sums
            for i in range(0, len(k), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k[i:i + 100_000]), pa.array(n[1][i:i + 100_000]),
                     pa.array(n[0][i:i + 100_000])], names=["key", "toxic", "ordinary"])

        for whole in batches:
            for b in text_slices(whole, "text"):
                for label, text in zip(b.column("label").to_pylist(), b.column("text").to_pylist()):
                    k = np.unique(_keys(_ids(tokens(text))))
                    if len(k):
                        held[1 if label else 0].append(k)
                        size += len(k)
                        if size > 2_000_000:
                            fold()
            if sums is not None and len(sums[0]) > 4_000_000:
                # Memory stays bounded; the shuffle adds up what is sent in parts.
                yield from rows_out()
                sums = None
        fold()
        if sums is not None:
            yield from rows_out()

    return (rows.select("label", "text").mapInArrow(run, "key long, toxic long, ordinary long")
            .groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))


def _ids(words: np.ndarray) -> np.ndarray:
    """crc32 values as word ids; RARE and START are no words."""
    return np.maximum(words, np.uint32(2))


def _pairs(words: np.ndarray) -> np.ndarray:
    """(word before << 32 | word) for every word; START stands before the first."""
    before = np.concatenate([[START], words[:-1]]).astype(np.uint64)
    return ((before << np.uint64(32)) | words.astype(np.uint64)).astype(np.int64)


def _keys(words: np.ndarray) -> np.ndarray:
    """Keys of the words of a text (no word before) and of its pairs."""
    if not len(words):
        return np.empty(0, np.int64)
    return np.concatenate([words.astype(np.int64), _pairs(words)])


def _frequent(rows: DataFrame) -> list:
    """``rows(key, ...)`` of longs as packed parts ``(size, column, ...)``, sorted by key inside.

    The executors pack them, and only the tasks that score texts unpack them.
    """
    names = rows.columns

    def run(batches):
        held = [[b.column(c).to_numpy() for c in names] for b in batches if b.num_rows]
        if held:
            cols = [np.concatenate(c) for c in zip(*held)]
            order = np.argsort(cols[0])
            cols = [c[order].astype(np.int64) for c in cols]
            cols[0] = np.diff(cols[0], prepend=np.int64(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(order)])] + [pa.array([_packed(c)], pa.binary()) for c in cols], names=["size", *names])

    schema = ", ".join(["size long", *[f"`{c}` binary" for c in names]])
    return [(r[0], *map(bytes, r[1:])) for r in rows.mapInArrow(run, schema).collect()]


def _table(parts: list, width: int) -> list[np.ndarray]:
    """The columns of all parts, sorted by the first; the others as narrow as their values allow."""
    cols = [np.concatenate([np.empty(0, np.int64)] + [_unpacked(p[i + 1], p[0], np.int64) for p in parts])
            for i in range(width)]
    at = 0
    for size, *_ in parts:
        cols[0][at:at + size] = np.cumsum(cols[0][at:at + size])
        at += size
    order = np.argsort(cols[0], kind="stable")
    return [cols[0][order]] + [c[order].astype(np.min_scalar_type(c.max(initial=0))) for c in cols[1:]]


class Tables:
    """The counts that any setting reads: frequent words, frequent pairs, and the words before those."""

    def __init__(self, counts: tuple, least: float = LEAST):
        """counts: packed (word, toxic, ordinary, kinds of words before), (word before, toxic,
        ordinary), (pair, toxic, ordinary), and (toxic, ordinary, kinds) of all rarer words.
        Pairs in fewer than ``least`` texts are not kept: no setting that is asked for reads them."""
        words, before, pairs, rest = counts
        ids, toxic, plain, kinds = _table(words, 4)
        # RARE stands for every other word.
        self.vocab = np.concatenate([[RARE], ids.astype(np.uint32)]).astype(np.uint32)
        self.n = np.stack([np.concatenate([[r], c]).astype(np.float64)
                           for r, c in ((rest[1], plain), (rest[0], toxic))])
        self.follows = np.concatenate([[rest[2]], kinds]).astype(np.float64)
        ctx, toxic, plain = _table(before, 3)
        self.ctx, self.ctx_n = ctx.astype(np.uint32), np.stack([plain, toxic]).astype(np.float64)
        # The place in ctx of every word of vocab, or -1; START has no place in vocab.
        self.ctx_of = np.full(len(self.vocab), -1, np.int32)
        at = np.minimum(np.searchsorted(self.vocab, self.ctx), len(self.vocab) - 1)
        there = self.vocab[at] == self.ctx
        self.ctx_of[at[there]] = np.flatnonzero(there)
        self.start = next(iter(np.flatnonzero(self.ctx == START)), -1)
        self.pairs, toxic, plain = _table(pairs, 3)
        self.pair_n = np.stack([plain, toxic])
        kept = self.pair_n.sum(0, dtype=np.int64) >= least
        self.pairs, self.pair_n = self.pairs[kept], self.pair_n[:, kept]

    def find(self, words: np.ndarray) -> tuple:
        """Places of the words (0: rare) and of the words before (-1: none), which words end a pair, and its place."""
        at = np.minimum(np.searchsorted(self.vocab, words), len(self.vocab) - 1)
        at = np.where(self.vocab[at] == words, at, 0)
        if not len(self.pairs) or not len(words):
            return at, None
        c = np.concatenate([[self.start], self.ctx_of[at[:-1]]])
        # A frequent pair has frequent words only.
        likely = np.flatnonzero((c >= 0) & (at > 0))
        keys = _pairs(words)[likely]
        k = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        there = self.pairs[k] == keys
        return at, (c, likely[there], k[there])


class Models:
    """Log-likelihood ratio of words under the two frozen models."""

    def __init__(self, tables: Tables, rare_below: float):
        n, follows = tables.n, tables.follows
        self.tables, self.rare_below = tables, rare_below
        rare = n.sum(0) < rare_below
        rare[0] = True
        self.row = np.where(rare, 0, np.arange(len(rare), dtype=np.int32))
        n = np.stack([np.bincount(self.row, c, len(rare)) for c in n])
        shared = np.where(rare, 0.0, np.maximum(follows, 0.5))
        shared[0] = max(follows[rare].sum(), 0.5)
        kept = np.maximum(n - DISCOUNT, 0.0)
        total = np.maximum(n.sum(1, keepdims=True), 1.0)
        left = 1.0 - kept.sum(1, keepdims=True) / total
        self.uni = kept / total + np.maximum(left, 1e-9) * shared / shared.sum()
        if len(tables.pairs):
            at = np.searchsorted(tables.ctx, (tables.pairs >> 32).astype(np.uint32))
            rare = tables.pair_n.sum(0, dtype=np.int64) < rare_below
            self.size = np.maximum(tables.ctx_n, 1.0)
            used = np.stack([np.bincount(at, np.where(rare, 0.0, np.maximum(c - DISCOUNT, 0.0)), len(tables.ctx))
                             for c in tables.pair_n])
            self.left = np.clip(1.0 - used / self.size, 1e-9, 1.0)

    def ratio(self, found: tuple, bigrams: bool) -> float:
        """Mean log P(word | before, toxic) - log P(word | before, ordinary)."""
        at, pairs = found
        if not len(at) or len(self.row) < 2:
            return 0.0
        p = self.uni[:, self.row[at]]
        if bigrams and pairs is not None:
            c, spots, k = pairs
            p = np.where(c >= 0, self.left[:, c], 1.0) * p
            n = self.tables.pair_n[:, k].astype(np.float64)
            p[:, spots] += (np.where(n.sum(0) < self.rare_below, 0.0, np.maximum(n - DISCOUNT, 0.0))
                            / self.size[:, c[spots]])
        logs = np.log(p)
        return float((logs[1] - logs[0]).mean())


def fit(rows: DataFrame, held: DataFrame) -> tuple:
    """Models from ``rows (doc_id, text, label)``, probability scale from ``held``.

    All rows are counted, and every count that a setting reads reaches the
    tasks that score.  Without rows every score is 0.5 or the share of toxic
    rows in ``held``, which also choose the setting.
    """
    counted = written(_class_counts(rows), "kn-counts")
    before, n = F.shiftrightunsigned("key", 32), F.col("toxic") + F.col("ordinary")
    words, pairs = counted.where(before == 0), counted.where(before != 0)
    follows = (pairs.groupBy(F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("key"))
               .agg(F.count("*").alias("kinds")))
    frequent = _frequent(words.where(n >= LEAST).join(follows, "key").select("key", "toxic", "ordinary", "kinds"))
    of_rare = words.where(n < LEAST).join(follows, "key").agg(F.sum("toxic"), F.sum("ordinary"), F.sum("kinds"))
    # A word before no frequent pair leaves all to the word alone, as one that was never seen.
    ctx = (pairs.groupBy(before.alias("key")).agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"),
                                                  F.max(n).alias("most"))
           .where(F.col("most") >= LEAST).select("key", "toxic", "ordinary"))
    counts = (frequent, _frequent(ctx), _frequent(pairs.where(n >= LEAST).select("key", "toxic", "ordinary")),
              tuple(float(x or 0) for x in of_rare.first()))
    grid = [(r, b) for r in RARE_BELOW for b in (True, False)]
    choice, at, share = _choose(_ratios(held, counts, grid), len(grid))
    return counts, grid[choice], at, share


def _ratios(df: DataFrame, counts: tuple, grid: list, text_col: str = "text") -> DataFrame:
    """Add ``mk_ratios``: the log-likelihood ratio under every setting of ``grid``."""
    shared = df.sparkSession.sparkContext.broadcast(counts)

    def make():
        least = min((r for r, bigrams in grid if bigrams), default=np.inf)
        tables, tokens = Tables(shared.value, least), TokenIds(lower=True)
        models = [(Models(tables, r), [b for _, b in same]) for r, same in groupby(grid, lambda s: s[0])]

        def fn(texts):
            out = []
            for t in texts:
                found = tables.find(_ids(tokens(t)))
                out.append([m.ratio(found, b) for m, kinds in models for b in kinds])
            return [out]
        return fn
    return map_text(df, make, [T.StructField("mk_ratios", T.ArrayType(T.DoubleType()))], text_col)


def _rank_quality(x, n, pos) -> float:
    """Share of toxic-ordinary pairs of rows in the right order (ties count half)."""
    order = np.argsort(x)
    t, o = pos[order], (n - pos)[order]
    below = np.cumsum(o) - o / 2
    return float((t * below).sum() / max(t.sum() * o.sum(), 1.0))


def _isotonic(x, n, pos) -> tuple[np.ndarray, np.ndarray]:
    """Rising step curve of the toxic share over the ratio.

    Neighbouring bins whose shares fall are pooled until none falls.
    """
    blocks: list[list[float]] = []      # [weight, positives, weight * x]
    for i in np.argsort(x):
        blocks.append([n[i], pos[i], n[i] * x[i]])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    w, k, wx = (np.array(c) for c in zip(*blocks))
    share = (k + 0.5 * k.sum() / w.sum()) / (w + 0.5)
    return wx / w, np.maximum.accumulate(share)


def _choose(held: DataFrame, settings: int) -> tuple:
    """The setting that orders all held rows best, and its curve.

    The rows are first counted in bins of the ratio, of which there is a fixed
    number, so the driver sees counts only.
    """
    x = F.round(F.greatest(F.lit(-2.0), F.least(F.lit(2.0), F.col("ratio"))) * 500) / 500
    bins = (held.select("label", F.posexplode("mk_ratios").alias("setting", "ratio"))
            .groupBy("setting", x.alias("x")).agg(
                F.count("*").alias("n"), F.sum((F.col("label") > 0).cast("long")).alias("pos"))
            .toPandas())
    best = (-1.0, 0, np.array([0.0]), np.array([0.5]))
    for k in range(settings):
        part = [bins.loc[bins["setting"] == k, c].to_numpy(np.float64) for c in ("x", "n", "pos")]
        if len(part[0]):
            quality = _rank_quality(*part)
            if quality > best[0]:
                best = (quality, k, *_isotonic(*part))
    return best[1:]


def predict(df: DataFrame, model: tuple, text_col: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1, higher: toxic likelier) to every row.

    Null and empty texts have ratio 0 and get the score of an undecided text.
    """
    counts, setting, at, share = model
    out = _ratios(df, counts, [setting], text_col)
    curve = df.sparkSession.sparkContext.broadcast((at, share))

    @F.pandas_udf("double")
    def probability(ratios: pd.Series) -> pd.Series:
        x, y = curve.value
        r = np.array([v[0] for v in ratios], dtype=np.float64)
        # A small share of the plain ratio keeps the order inside a step.
        return pd.Series(0.99 * np.interp(r, x, y) + 0.01 / (1 + np.exp(-np.clip(4 * r, -50, 50))))

    return out.withColumn("score", probability("mk_ratios")).drop("mk_ratios")
