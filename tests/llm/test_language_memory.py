"""What the language model holds in a task, and that its figures stay those of the plain trees."""

import tracemalloc
from collections import Counter

import numpy as np

from modelyard.llm import ppm_language
from modelyard.llm.bpe import TreeBpe
from modelyard.llm.queries import vocabulary

from ..conftest import spark  # noqa: F401

TEXTS = {"en": "the cat and the dog went over the hill ", "de": "der hund und die katze gehen über den berg "}


def _tables():
    return [np.unique(ppm_language.triples(TEXTS[lang] * 3), return_counts=True) for lang in sorted(TEXTS)]


def test_a_scorer_is_as_large_as_what_was_learned():
    tables = _tables()
    tracemalloc.start()
    scorer = ppm_language.Scorer(sorted(TEXTS), tables)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 16 << 20
    for text in [*TEXTS.values(), "", "a", "\x00\x00\x00", "zq\U0001f600 über", "the cat" * 5000]:
        plain = [ppm_language.LanguageTree(*t).bits(ppm_language.triples(text).astype(np.int64)).sum() for t in tables]
        assert np.allclose(scorer.lengths(text), plain)
    assert len(ppm_language.Scorer([], []).lengths("abc")) == 0


def test_counts_of_many_folds_are_those_of_all_texts(spark):  # noqa: F811
    rows = [(lang, text * 4000) for lang, text in TEXTS.items() for _ in range(20)]
    rows += [(None, "left out"), ("en", None), ("fr", "")]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    got = {(r["lang"], r["triple"]): r["n"] for r in ppm_language.count_triples(docs, "text", "lang").collect()}
    want = Counter()
    for lang, text in TEXTS.items():
        keys, n = np.unique(ppm_language.triples(text * 4000), return_counts=True)
        want.update({(lang, int(k)): 20 * int(v) for k, v in zip(keys, n)})
    assert got == dict(want)


def test_a_word_that_stands_alone_is_kept_once():
    with open(vocabulary("word_bpe_49k.json"), encoding="utf-8") as f:
        bpe = TreeBpe(f.read())
    once = bpe.encode("hill dog hill, dog Hill dog")
    assert "dog" in bpe.chunks and "dog" not in bpe.words and "hill" in bpe.words
    assert bpe.encode("hill dog hill, dog Hill dog") == once
