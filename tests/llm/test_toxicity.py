"""Toxicity models: every count that a setting reads is there, whatever its share."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.llm import toxicity
from modelyard.session import ship_package

from ..conftest import spark  # noqa: F401


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):  # noqa: F811
    ship_package(spark)


def _id(word):
    return zlib.crc32(word.encode())


def test_counts_do_not_depend_on_their_share(spark):  # noqa: F811
    """11 texts with a word and a pair of 11 million of either."""
    common = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(25_000)), lambda i: F.concat(F.lit("w"), i)))
    mark = F.when(F.col("id") < 11, F.lit("vile deed ")).otherwise(F.lit(""))
    rows = spark.range(0, 440, 1, 4).select(F.col("id").alias("doc_id"), F.concat(mark, common).alias("text"),
                                            (F.col("id") < 11).cast("int").alias("label"))
    counts = toxicity.fit(rows, rows.limit(0))[0]
    tables = toxicity.Tables(counts)
    at = {int(w): i for i, w in enumerate(tables.vocab)}
    for word in ("vile", "deed"):
        assert list(tables.n[:, at[_id(word)]]) == [0, 11]
    pairs = dict(zip(tables.pairs.tolist(), tables.pair_n.T.tolist()))
    signed = int(np.uint64(_id("vile") << 32 | _id("deed")).astype(np.int64))
    assert pairs[signed] == [0, 11]


def _plain_ratio(train, words, rare_below, bigrams):
    """The log-likelihood ratio from counts of all words and pairs in dicts."""
    uni, pair = [Counter(), Counter()], [Counter(), Counter()]
    for text, label in train:
        ws = text.split()
        uni[label].update(set(ws))
        pair[label].update(set(zip(["<s>", *ws], ws)))
    both, both_pairs = uni[0] + uni[1], pair[0] + pair[1]
    kinds = Counter(w for _, w in both_pairs)

    def name(w):
        return w if both[w] >= rare_below else None
    total_kinds = Counter()
    for w, n in kinds.items():
        total_kinds[name(w)] += n
    mean = 0.0
    for before, w in zip(["<s>", *words], words):
        logs = []
        for label in (0, 1):
            n = Counter()
            for x, c in uni[label].items():
                n[name(x)] += c
            size = max(sum(n.values()), 1)
            kept = {x: max(c - 0.75, 0) for x, c in n.items()}
            left = 1 - sum(kept.values()) / size
            p = kept.get(name(w), 0) / size + left * total_kinds[name(w)] / sum(total_kinds.values())
            if bigrams:
                own = {(v, x): max(c - 0.75, 0) for (v, x), c in pair[label].items()
                       if v == before and both_pairs[v, x] >= rare_below}
                size = max(sum(c for (v, _), c in pair[label].items() if v == before), 1)
                p = own.get((before, w), 0) / size + max(1 - sum(own.values()) / size, 1e-9) * p
            logs.append(np.log(p))
        mean += (logs[1] - logs[0]) / len(words)
    return mean


def test_ratios_equal_those_of_all_words_and_pairs(spark):  # noqa: F811
    rng = np.random.default_rng(8)
    vocab = [f"{a}{b}" for a in "bcdfg" for b in "aeiou"] + [f"rare{i}" for i in "abcdefghijklmnop"]
    weight = np.array([30.0] * 12 + [4.0] * 13 + [1.0] * 16)

    def text():
        return " ".join(rng.choice(vocab, int(rng.integers(3, 12)), p=weight / weight.sum()))
    train = [(text() + (" ba da" if i % 3 else ""), int(i % 3 == 0)) for i in range(120)]
    tests = [text() for _ in range(12)] + ["never seen words", "ba da ba da", "raree unseen"]
    rows = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(train)], "doc_id long, text string, label int")
    counts = toxicity.fit(rows, rows)[0]
    grid = [(r, b) for r in toxicity.RARE_BELOW[:2] for b in (True, False)]
    docs = spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string")
    for r in toxicity._ratios(docs, counts, grid).collect():
        want = [_plain_ratio(train, r["text"].split(), limit, b) for limit, b in grid]
        assert r["mk_ratios"] == pytest.approx(want, abs=1e-9)
