"""Operators 11 to 13 against brute force, the library they must equal, and odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from modelyard.llm import periodic_runs, phrases, token_counts
from modelyard.llm.queries import vocabulary
from modelyard.session import ship_package

from ..conftest import spark  # noqa: F401


@pytest.fixture(scope="module")
def odd(spark):  # noqa: F811
    """Null id, null, empty and blank texts, repeated rows, a very long text, clashing columns."""
    ship_package(spark)
    rows = [(None, "one two one two"), (1, None), (2, ""), (3, " \n\t"), (4, "a b c. " * 9),
            (4, "a b c. " * 9), (5, "word " * 70_000), (6, "!!! ###")]
    return (spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
            .withColumns({c: F.lit("mine") for c in ("n", "block", "place", "id", "n_bytes", "start", "words")}))


# -- 11 ----------------------------------------------------------------------
def runs_brute(words, least=12):
    """Every stretch with each period, kept when it is the smallest and can't grow."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, 2 * q):
                part = words[i:i + size]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    kind = rng.randrange(4)
    if kind == 0:
        return [rng.choice("ab") for _ in range(rng.randrange(0, 80))]
    if kind == 1:
        return [rng.choice("abc") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 120))]
    words = [str(rng.randrange(30)) for _ in range(rng.randrange(1, 40))]
    for _ in range(rng.randrange(1, 4)):
        at, p = rng.randrange(len(words)), rng.randrange(1, 9)
        words[at:at] = (words[at:at + p] or ["x"]) * rng.randrange(2, 9)
    return words * (3 if kind == 3 and len(words) < 60 else 1)


def test_runs_equal_brute_force():
    rng = random.Random(5)
    texts = [random_words(rng) for _ in range(400)]
    # Long periods, in random words and inside one another.
    for period in (15, 16, 17, 31, 32, 33, 50, 64, 90):
        loop = [rng.choice("abcdefgh") for _ in range(period)]
        inner = ["x"] * 13 + loop + ["y", "z"] * 9
        texts += [["p"] + loop * 2 + ["q"], loop * 3 + loop[:5], inner * 2, inner * 3 + ["x"]]
    got = periodic_runs.find([[w.encode() for w in t] for t in texts])
    for words, runs in zip(texts, got):
        assert runs == runs_brute(words), words
    assert sum(map(len, got)) > 300


def test_splitting_goes_on_until_nothing_is_rare():
    import numpy as np
    # "a" and "c" become rare only after "x" and "y" have split the text.
    words = "a b c d e f g h i j k l x a m c n o p q r s t u v".split()
    loop = list("uvw") * 5
    ids = {w: i for i, w in enumerate(dict.fromkeys(words + loop))}
    flat = np.array([ids[w] for w in words] + [99] + [ids[w] for w in loop])
    assert periodic_runs.split_rare(flat, np.zeros(len(flat), int), 12) == [(26, 41)]


def looped_brute(text, doc_id):
    words = text.encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    return [w.decode() for w in words]


def report_brute(doc_id, text):
    words = looped_brute(text or "", doc_id)
    runs = runs_brute(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            hashlib.sha256(left.encode()).hexdigest())


def test_periodic_report_equals_brute_force(spark):  # noqa: F811
    ship_package(spark)
    rng = random.Random(6)
    rows = [(i, " ".join(random_words(rng)) + rng.choice(["", " \n", "\x0b\x0c"])) for i in range(300)]
    rows += [(7_000_001, None), (7_000_002, ""), (7_000_003, "é è " * 20), (7_000_003, "é è " * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    read = periodic_runs.looped_texts(docs)
    got = sorted(map(tuple, periodic_runs.report(periodic_runs.periodic_runs(read), "doc_id").collect()))
    assert got == sorted(report_brute(*r) for r in rows)


def test_runs_of_odd_rows(spark, odd):  # noqa: F811
    found = periodic_runs.periodic_runs(odd)
    assert found.columns == odd.columns + ["runs", "collapsed"]
    got = {(r.doc_id, r.text and r.text[:5]): ([tuple(x) for x in r.runs], r.collapsed) for r in found.collect()}
    assert got[(1, None)] == got[(2, "")] == got[(3, " \n\t")] == ([], "")
    assert got[(None, "one t")] == ([], "one two one two")
    assert got[(4, "a b c")] == ([(0, 27, 3)], "a b c.")
    assert got[(5, "word ")] == ([(0, 70_000, 1)], "word")
    assert found.count() == 8
    empty = periodic_runs.report(periodic_runs.periodic_runs(odd.limit(0)), "doc_id")
    assert empty.count() == 0
    assert found.withColumn("runs", F.lit(1)).transform(periodic_runs.periodic_runs).count() == 8


# -- 12 ----------------------------------------------------------------------
def phrases_brute(rows, least, longest, top):
    import re
    count = {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        c = count.setdefault(lang, Counter())
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            ws = re.findall("[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                c.update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, c in count.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        cands = {}
        for p, a in c.items():
            if len(p) >= 2 and a >= least:
                cands[p] = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
        def inside(p, q):
            return len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))
        kept = [p for p in cands if not any(inside(p, q) and 100 * c[q] >= 80 * c[p] for q in cands)]
        kept.sort(key=lambda p: (-cands[p][0], -c[p], " ".join(p).encode()))
        for rank, p in enumerate(kept[:top], 1):
            k = cands[p][1]
            out.append((lang, rank, " ".join(p), c[p], c[p[:k]], c[p[k:]], n, cands[p][0]))
    return sorted(out)


@pytest.mark.parametrize("block_words, top", [(1 << 20, 2000), (7, 11)])
def test_phrases_equal_brute_force(spark, block_words, top):  # noqa: F811
    ship_package(spark)
    rng = random.Random(block_words)
    vocab = ["The", "the", "of", "a", "é", "x-y", " ", "z", "Äb"]
    rows = []
    for _ in range(120):
        words = [rng.choice(vocab) + rng.choice(["", "", "", "", ".", ",\n", "\t"]) for _ in range(rng.randrange(40))]
        rows.append((rng.choice(["en", "de", None, "und", ""]), " ".join(words) + " of the z" * rng.randrange(5)))
    rows += [("en", None), ("en", ""), ("xx", "..."), ("en", "the of " * 60), ("en", "the of " * 60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = phrases.collocations(docs, least=9, top=top, block_words=block_words)
    assert sorted(map(tuple, got.collect())) == phrases_brute(rows, 9, 4, top)


def test_phrases_of_odd_rows(spark, odd):  # noqa: F811
    got = [tuple(r) for r in phrases.collocations(odd, least=9).collect()]
    assert got == [tuple(r) for r in phrases_brute([(None, r.text) for r in odd.collect()], 9, 4, 2000)]
    assert any(r[2] == "a b c" for r in got)
    assert phrases.collocations(odd.limit(0)).collect() == []


def test_large_counts_stay_exact(spark):  # noqa: F811
    big = 9_000_000_000_000_000_000
    rows = [("en", 1, "a", big), ("en", 1, "b", big - 7), ("en", 2, "a b", big - 9),
            ("en", 3, "a b a", big // 5 * 4), ("en", 2, "b a", big - 11)]
    table = spark.createDataFrame(rows, "lang string, k int, phrase string, a long")
    got = {r.phrase: r for r in phrases.scored(table).collect()}
    assert got["a b"].score == 2_000_000 * (big - 9) // (2 * big - 7)
    assert got["a b a"].l == min((2_000_000 * (big // 5 * 4) // (x + y), k, x) for k, x, y in
                                 [(1, big, big - 11), (2, big - 9, big)])[2]
    # 100 * f >= 80 * a: the longer one has a hair more than four fifths of both.
    assert {r.phrase for r in phrases.maximal(phrases.scored(table)).collect()} == {"a b a"}


# -- 13 ----------------------------------------------------------------------
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def odd_texts():
    rng = random.Random(3)
    alphabets = ["abcdefghij ", "the ing tion er ", "Aé'sß İıǅ́ ", "0123456789,.-!?'s\n\t", "日本語 がゃ゙",
                 "    x\x1c\x85", "ΑΣ σς", "😀👍🏽‍ ", "<|endoftext|> <|startoftext|>x"]
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(60))) for _ in range(600)]
    texts += ["".join(rng.choice(a) for _ in range(rng.randrange(200))) for a in alphabets for _ in range(40)]
    texts += ["<|endoftext|>", "a<|endoftext|>b <|startoftext|><|endoftext|", "<|<|endoftext|>|>", "a" * 5000,
              "".join(rng.choice("abcde") for _ in range(20_000)), "don't they'll we've I'm", "é" * 99]
    return texts


def test_counts_equal_the_library():
    with open(vocabulary("word_bpe_49k.json"), encoding="utf-8") as f:
        counter = token_counts.HeapCounter(f.read(), cache=50)
    t = library()
    for text in odd_texts():
        assert counter.count(text) == len(t.encode(text, add_special_tokens=False).ids), text[:80]


def test_merges_follow_rank_then_place():
    class Bare(token_counts.HeapCounter):
        def __init__(self, merges):
            pairs = [tuple(m.split()) for m in merges]
            self.ranks = {p: i for i, p in enumerate(pairs)}
            self.known = {x for p in pairs for x in p}
    assert Bare(["a a"]).merged(list("aaaaa")) == 3
    assert Bare(["b c", "a b"]).merged(list("abc")) == 2
    assert Bare(["a b", "b c", "ab c"]).merged(list("abcabc")) == 2
    assert Bare(["a b"]).merged(list("axb")) == 1  # an unknown symbol is dropped, as the library does


def test_token_counts_of_odd_rows(spark, odd):  # noqa: F811
    got = token_counts.limits(token_counts.count_tokens(odd, vocabulary("word_bpe_49k.json")), 2048)
    t = library()
    for r in got.collect():
        n = len(t.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((r.text or "").encode()), n > 2048)
    assert got.count() == 8
    assert token_counts.count_tokens(odd.limit(0), vocabulary("word_bpe_49k.json")).count() == 0
