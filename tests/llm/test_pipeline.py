"""Every stage of the corpus pipeline against a plain version, and on odd rows."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from modelyard.llm import ppm_language
from modelyard.llm.keys import fold
from modelyard.llm.queries import vocabulary
from modelyard.session import ship_package

from ..conftest import spark  # noqa: F401
from .test_operators import _brute_lines

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
SPEECH = {"en": "the cat and the dog went over the hill with all their friends".split(),
          "de": "der hund und die katze gehen mit allen freunden nach hause zurück".split()}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):  # noqa: F811
    """A folder with documents and benchmark, and the documents as rows."""
    ship_package(spark)
    rng, rows = np.random.default_rng(2), []
    for i in range(60):
        lang = ("en", "de")[i % 2]
        words = list(rng.choice(SPEECH[lang], 80)) + [f"{lang}{i}"] * 2
        rows.append((i, "\n".join(" ".join(words[a:a + 20]) for a in range(0, 82, 20)), lang, "web", 0))
    item = " ".join(f"exam{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(30))
    rows += [(70, rows[0][1] + " more", "en", "web", 0), (71, rows[1][1], "de", None, 0),
             (72, f"the cat and the dog {item} went over the hill", "en", "web", 0),
             (80, None, "en", "web", None), (81, "", None, None, 0), (82, "12 34 !!", "en", "web", 8)]
    at = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.createDataFrame([(i, t, l, s, n if n is None else len(t or "")) for i, t, l, s, n in rows], COLUMNS)
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([("a", item), ("b", None), ("c", "")], "item_id string, text string").write.parquet(
        f"{at}/benchmark.parquet")
    return at, item


def _grams(text):
    w = re.findall(r"[^\W_]+", text.lower())
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def test_stages_equal_plain_versions(spark, tables):  # noqa: F811
    at, item = tables
    docs = spark.read.parquet(f"{at}/documents.parquet")
    model = ppm_language.fit(docs.where(fold("doc_id", 5) != 0))
    judged = {r["doc_id"]: r for r in ppm_language.predict(docs, model).collect()}
    kept = cp.language(spark, docs, at)
    assert {r["doc_id"] for r in kept.collect()} == {
        i for i, r in judged.items() if r["lang_pred"] != "und" and r["score"] >= 0.5}
    assert not {80, 81, 82} & {r["doc_id"] for r in kept.collect()}

    lined = cp.lines(spark, kept, at).collect()
    want = {i: t for i, t in _brute_lines(kept).items() if re.search(r"[^\W_]", t)}
    assert {r["doc_id"]: r["text"] for r in lined} == want
    assert all(r["n_chars"] == len(r["text"]) for r in lined)
    lined = spark.createDataFrame(lined, COLUMNS)

    sets = {r["doc_id"]: _grams(r["text"]) for r in docs.where("doc_id < 80").collect()}
    firsts = [i for i in sorted(sets) if not any(
        len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in sets if j < i)]
    near = cp.near_copies(spark, docs.where("doc_id < 80"), at)
    assert sorted(r["doc_id"] for r in near.collect()) == firsts and 71 not in firsts and 70 not in firsts

    clean = cp.benchmark_passages(spark, docs, at)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(
        r["doc_id"] for r in docs.collect() if r["doc_id"] != 72)
    for out in (kept, lined, near, clean):
        assert out.columns == docs.columns

    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    lib.no_truncation(), lib.no_padding()
    for r in cp.tokens(spark, docs, at).join(docs.select("doc_id", "text"), "doc_id").collect():
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_pipeline_end_to_end_and_empty(spark, tables, tmp_path):  # noqa: F811
    at, _ = tables
    out = cp.run(spark, at).collect()
    assert len(out) == len({r["doc_id"] for r in out}) > 0
    assert not {71, 72, 80, 81, 82} & {r["doc_id"] for r in out}
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{at}/{name}.parquet").where(F.lit(False)).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_stages_leave_clashing_columns_alone(spark, tables):  # noqa: F811
    at, _ = tables
    names = ["score", "lang_pred", "n_lines", "n_removed", "n_words", "n_hit", "contaminated", "class_id", "set",
             "is_first", "n_links"]
    docs = spark.read.parquet(f"{at}/documents.parquet").withColumns(
        {c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in names})
    for stage in (cp.language, cp.lines, cp.near_copies, cp.benchmark_passages):
        out = stage(spark, docs, at)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == f"{c}-{r['doc_id']}" for r in rows for c in names)
