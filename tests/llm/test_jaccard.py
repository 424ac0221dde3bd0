"""The chosen-path join against all pairs: deep trees, far sets, large groups of near copies."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.llm import chosen_path
from modelyard.session import ship_package

from ..conftest import spark  # noqa: F401


def sets_of(texts):
    out = []
    for t in texts:
        w = (t or "").lower().split()
        out.append({tuple(w[i:i + 5]) for i in range(max(0, len(w) - 4))} or ({tuple(w)} if w else set()))
    return out


def brute(texts, similarity=0.8):
    """(class, links) of every text from the sizes of all intersections."""
    sets = sets_of(texts)
    names = {g: i for i, g in enumerate({g for s in sets for g in s})}
    m = np.zeros((len(sets), len(names)), np.float32)
    for i, s in enumerate(sets):
        m[i, [names[g] for g in s]] = 1
    both = m @ m.T
    sizes = m.sum(1)
    ok = both * (1 + similarity) >= similarity * (sizes[:, None] + sizes[None, :]) - 1e-6
    ok &= sizes[:, None] > 0
    np.fill_diagonal(ok, False)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i, j in zip(*np.nonzero(ok)):
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return [find(i) for i in range(len(sets))], ok.sum(1).tolist(), ok


def run(spark, texts):  # noqa: F811
    ship_package(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = {r["doc_id"]: r for r in chosen_path.jaccard_classes(docs).collect()}
    return [rows[i]["class_id"] for i in range(len(texts))], [rows[i]["n_links"] for i in range(len(texts))]


def edited(rng, words, n):
    w = list(words)
    for i in rng.choice(len(w), n, replace=False):
        w[i] = f"e{rng.integers(1 << 40)}"
    return w


@pytest.mark.parametrize("small", [False, True])
def test_near_copies_far_copies_and_chains(spark, monkeypatch, small):  # noqa: F811
    if small:
        for name, value in (("CHUNK", 7), ("STAR", 5), ("SMALL_NODE", 3)):
            monkeypatch.setattr(chosen_path, name, value)
    rng = np.random.default_rng(4)
    texts = []
    for _ in range(6):
        base = [f"b{rng.integers(1 << 40)}" for _ in range(150)]
        # Few edits: near; more: far, linked to some only; a chain drifts away from its start.
        texts += [" ".join(edited(rng, base, k)) for k in (0, 1, 1, 2, 2, 3, 3, 4, 5, 0)]
        step = base
        for _ in range(5):
            step = edited(rng, step, 2)
            texts.append(" ".join(step))
    texts += ["", None, "one two", "one two", "One  TWO", "a b c d e", "x " * 300, "x " * 400]
    got_class, got_links = run(spark, texts)
    want_class, want_links, _ = brute(texts)
    assert got_links == want_links
    assert got_class == want_class
    assert Counter(want_links).most_common(1)[0][0] != max(want_links)


def test_threshold_pairs_inside_a_similar_crowd(spark):  # noqa: F811
    """Pairs of 0.8 to 0.87 among 4,000 sets that share half their shingles with one another."""
    rng = np.random.default_rng(12)
    shared = [f"s{i}" for i in range(100)]
    texts, pairs = [], []
    for i in range(2000):
        own = [f"o{i}w{j}" for j in range(100)]
        if i < 150:
            twin = edited(rng, own, 4)          # about 20 of 200 shingles differ
            pairs.append((len(texts), len(texts) + 1))
            texts += [" ".join(shared + own), " ".join(shared + twin)]
        else:
            texts += [" ".join(shared + own), " ".join(shared + [f"p{i}w{j}" for j in range(100)])]
    sims = []
    sets = sets_of([t for p in pairs for t in (texts[p[0]], texts[p[1]])])
    for k in range(len(pairs)):
        a, b = sets[2 * k], sets[2 * k + 1]
        sims.append(len(a & b) / len(a | b))
    close = [p for p, s in zip(pairs, sims) if s >= 0.8]
    assert len(close) > 100 and np.median(sims) < 0.88
    got_class, got_links = run(spark, texts)
    met = sum(got_class[a] == got_class[b] for a, b in close)
    assert met >= 0.97 * len(close)
    linked = {i for p in close for i in p}
    assert all(got_links[i] == 0 for i in range(len(texts)) if i not in linked)


def test_recall_is_reckoned_for_the_depth():
    assert chosen_path.runs_for(0.999, 0.8, 2) == 6
    rng = np.random.default_rng(1)
    runs = chosen_path.runs_for(0.9, 0.8, 5)
    hits = 0
    for _ in range(400):
        core = rng.integers(0, 1 << 62, 80, dtype=np.uint64)
        a, b = [np.unique(np.concatenate([core, rng.integers(0, 1 << 62, 10, dtype=np.uint64)])) for _ in "ab"]
        roots = chosen_path._roots(int(rng.integers(1 << 40)), runs)
        hits += bool(np.intersect1d(chosen_path.paths(a, roots, 5, 0.8), chosen_path.paths(b, roots, 5, 0.8)).size)
    assert hits >= 0.87 * 400


def test_work_on_near_copies_is_linear(spark):  # noqa: F811
    """A group of near copies makes as many rows as sets, whatever its size."""
    ship_package(spark)
    rng = np.random.default_rng(6)
    base = [f"b{i}" for i in range(300)]
    texts = [" ".join(edited(rng, base, 1 + i % 3)) for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = chosen_path.jaccard_classes(docs).agg(
        F.count_distinct("class_id").alias("classes"), F.min("n_links").alias("least")).first()
    assert (got["classes"], got["least"]) == (1, 599)
