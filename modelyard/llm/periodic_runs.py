"""Periodic runs of words by recursive frequency splitting and a lag scan.

A run is a stretch of words with smallest period q, at least ``max(least, 2q)``
long, which no neighbouring word extends.  Every word of a run stands in it
twice or more, so a word that stands once in its segment lies in no run and
splits the segment.  Splitting makes more words rare, and is repeated until
nothing changes; all texts of a batch are split together.  What is left is
scanned lag by lag.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_text

LEAST_WORDS = 12
_RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


def split_rare(words: np.ndarray, owner: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stable segments ``[a, b)`` of ``words``; segments never cross a change of ``owner``."""
    if not len(words):
        return []
    span = int(words.max()) + 1
    at = np.arange(len(words))
    seg = owner
    stable = []
    while len(at):
        edge = np.flatnonzero((np.diff(at) != 1) | (seg[1:] != seg[:-1])) + 1
        starts = np.concatenate([[0], edge])
        sizes = np.diff(np.concatenate([starts, [len(at)]]))
        number = np.repeat(np.arange(len(starts)), sizes)
        keep = np.repeat(sizes >= least, sizes)
        at, number = at[keep], number[keep]
        if not len(at):
            break
        _, place, times = np.unique(number * span + words[at], return_inverse=True, return_counts=True)
        rare = times[place] < 2
        split = np.zeros(len(starts), bool)
        split[number[rare]] = True
        for s in np.flatnonzero((sizes >= least) & ~split):
            a = int(at[np.searchsorted(number, s)])
            stable.append((a, a + int(sizes[s])))
        again = split[number] & ~rare
        at, seg = at[again], number[again]
    return sorted(stable)


def _stretch(words: np.ndarray, lag: int, i: int) -> tuple[int, int]:
    """The longest ``[a, b)`` around ``i`` in which every word equals the one ``lag`` later."""
    end = len(words) - lag
    b, step = i, 64
    while b < end:
        e = min(end, b + step)
        diff = np.flatnonzero(words[b:e] != words[b + lag:e + lag])
        if len(diff):
            b += int(diff[0])
            break
        b, step = e, step * 2
    a, step = i, 64
    while a > 0:
        s = max(0, a - step)
        diff = np.flatnonzero(words[s:a] != words[s + lag:a + lag])
        if len(diff):
            a = s + int(diff[-1]) + 1
            break
        a, step = s, step * 2
    return a, b


# Lags below this are compared at every place; others from equal grams of
# half as many words on.
_SHORT_LAGS = 16
_GRAM = _SHORT_LAGS // 2


def _gram_hashes(words: np.ndarray) -> np.ndarray:
    """A hash of the ``_GRAM`` words from every place on (fewer places than words)."""
    h = words.astype(np.uint64) + np.uint64(1)
    for step, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xD6E8FEB86659FD93), (4, 0xA24BAED4963EE407)):
        h = h[:-step] * np.uint64(factor) + (h[step:] ^ (h[step:] >> np.uint64(29)))
    return h


def lag_scan(words: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of one segment.

    A run of period q holds ``max(least - q, q)`` places in a row that equal the
    word q later.  Short lags are compared at every place.  Lags from ``s`` to
    ``2s`` are compared at places ``s / 2`` apart: one of them lies so early in
    the run's first period that the gram from there on comes again q later.
    Grams are compared by hash, for all lags of a scale at once; a hit is
    followed to its ends on the words themselves.  Hits that a known run of a
    shorter period explains are multiples of it.
    """
    n = len(words)
    runs: list[tuple[int, int, int]] = []
    for lag in range(1, min(n // 2, _SHORT_LAGS - 1) + 1):
        need = max(least - lag, lag)
        bad = np.flatnonzero(words[:n - lag] != words[lag:])
        ends = np.append(bad, n - lag)
        begins = np.append(0, bad + 1)
        for i in np.flatnonzero(ends - begins >= need):
            a, b = int(begins[i]), int(ends[i]) + lag
            if not any(p < lag and lag % p == 0 and s <= a and b <= s + size for s, size, p in runs):
                runs.append((a, b - a, lag))
    if n < 2 * _SHORT_LAGS:
        return runs
    grams = _gram_hashes(words)
    scale = _SHORT_LAGS
    while scale <= n // 2:
        step = scale // 2
        ahead = np.concatenate([grams[scale:], np.zeros(2 * scale, np.uint64)])
        anchors = grams[:max(0, len(grams) - scale):step]
        windows = np.lib.stride_tricks.sliding_window_view(ahead, scale)[::step][:len(anchors)]
        at, more = np.nonzero(windows == anchors[:, None])
        at, lag = at * step, more + scale
        inside = (at + lag < len(grams)) & (lag <= n // 2)
        at, lag = at[inside], lag[inside]
        for s, size, p in runs:
            if size > scale and len(at):
                other = ~((lag % p == 0) & (at >= s) & (at + lag < s + size))
                at, lag = at[other], lag[other]
        order = np.lexsort((at, lag))
        done, last = 0, 0
        new = []
        for i in order:
            a, q = int(at[i]), int(lag[i])
            if q == last and a < done:
                continue
            begin, end = _stretch(words, q, a)
            done, last = end, q
            if end - begin >= max(least - q, q):
                new.append((begin, end - begin + q, q))
        runs += new
        scale *= 2
    return runs


def find(texts: list[list[bytes]], least: int = LEAST_WORDS) -> list[list[tuple[int, int, int]]]:
    """The runs of every text (a list of words), by start, then period."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    words = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), sizes)
    first = np.cumsum(sizes) - sizes
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in split_rare(words, owner, least):
        t = int(owner[a])
        out[t] += [(a - int(first[t]) + s, length, p) for s, length, p in lag_scan(words[a:b], least)]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, without those a run holds after its first period, joined by one space."""
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return b" ".join(words)


def periodic_runs(df: DataFrame, text_col: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """Add ``runs array<struct<start, length, period>>`` and ``collapsed`` to every row.

    Words are the stretches without ASCII white space, numbered from 0.  Runs
    come by start, then period; ``collapsed`` is the text's words without the
    repeats.  Null and empty texts have no runs and an empty ``collapsed``;
    repeated rows get equal results; an empty table gives an empty one.  No row
    is dropped.  Input columns named ``runs`` or ``collapsed`` are replaced.
    """
    def make():
        def fn(texts):
            split = [t.encode("utf-8").split() if t else [] for t in texts]
            found = find(split, least)
            ends = np.cumsum([0] + [len(r) for r in found])
            flat = np.array([x for r in found for x in r], dtype=np.int64).reshape(-1, 3)
            runs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)],
                                              fields=[pa.field(f.name, pa.int64(), False) for f in _RUN])
            left = [collapse(w, r) for w, r in zip(split, found)]
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
                    pa.array(left, pa.binary()).cast(pa.string())]
        return fn

    return map_text(df, make, [T.StructField("runs", T.ArrayType(_RUN, False)),
                               T.StructField("collapsed", T.StringType())], text_col)


def looped_texts(df: DataFrame, text_col: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The table with the tail of some texts turned into a loop: where the id's hash ends in 0.

    With h = crc32 of the decimal id, g = h div 10 and n words: where h % 10 = 0
    and n > 0, word i >= a becomes word a + (i - a) % p, for a = g % n and
    p = 1 + (n - a) div (3 + g % 8).  Other texts, and those of a null id, stay.
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    words = F.array_remove(F.split(text_col, r"[\x20\x09-\x0D]+"), "")
    # Split once; the steps below only read what the one before has made.
    out = df.withColumns({"mk_words": F.when(h % 10 == 0, words), "mk_g": F.floor(h / 10).cast("bigint")})
    out = out.withColumn("mk_n", F.size("mk_words"))
    out = out.withColumn("mk_a", F.when(F.col("mk_n") > 0, F.col("mk_g") % F.col("mk_n")).cast("int"))
    rest = F.col("mk_n") - F.col("mk_a")
    out = out.withColumn("mk_p", (F.lit(1) + F.floor(rest / (F.lit(3) + F.col("mk_g") % 8))).cast("int"))
    cycle = F.array_repeat(F.slice("mk_words", F.col("mk_a") + 1, F.col("mk_p")), F.ceil(rest / F.col("mk_p")).cast("int"))
    tail = F.slice(F.flatten(cycle), F.lit(1), rest)
    made = F.array_join(F.concat(F.slice("mk_words", F.lit(1), F.col("mk_a")), tail), " ")
    return (out.withColumn(text_col, F.when(F.col("mk_a").isNotNull(), made).otherwise(F.col(text_col)))
            .drop("mk_words", "mk_g", "mk_n", "mk_a", "mk_p"))


def report(found: DataFrame, *keep: str) -> DataFrame:
    """Count, longest run (ties: least start, then period) and digests of runs and collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    with_best = found.withColumn("mk_best", best)
    length, period = F.col("mk_best.length"), -F.col("mk_best.period")
    return with_best.select(
        *keep, F.size("runs").cast("long").alias("n_runs"),
        (-F.col("mk_best.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.expr("(1000 * mk_best.length) div (-mk_best.period)").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256)
        .alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
