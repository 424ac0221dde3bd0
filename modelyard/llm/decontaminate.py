"""Benchmark decontamination as a prefix-filtered containment join.

A window is 13 consecutive words of a benchmark item, or the whole of a
shorter item.  Its words are ordered by how rare they are in the documents;
for full containment the necessary prefix is the rarest word.  Documents are
joined to windows on that word, positions where the window would not fit are
passed over (the length and positional bounds), and the rest is compared word
by word.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_text
from .graph import written

WINDOW = 13
SLICE_BYTES = 16 << 20     # benchmark text that one pass holds in memory

# Fixed values of the word rule: A-Z to lower case, then every ASCII byte that
# is no digit or lower-case letter separates words; other characters are kept.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else
               b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TABLE).split() if text else []


def windows_of(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


def word_counts(docs: DataFrame, vocabulary, text_col: str) -> DataFrame:
    """How often each broadcast word occurs in all documents."""
    def run(batches):
        from collections import Counter

        import pyarrow as pa
        wanted, seen = vocabulary.value, Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(filter(wanted.__contains__, words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
            names=["word", "n"])

    return (docs.select(F.col(text_col).alias("t")).mapInArrow(run, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def build_index(items: list[tuple[str, list[bytes]]], counts: dict[bytes, int], size: int = WINDOW):
    """rarest word -> [(its place in the window, window, item ids)]."""
    owners: dict[tuple[bytes, ...], set[str]] = {}
    for item_id, words in items:
        for w in windows_of(words, size):
            owners.setdefault(w, set()).add(item_id)
    index: dict[bytes, list] = {}
    for window, ids in owners.items():
        at = min(range(len(window)), key=lambda i: (counts.get(window[i], 0), window[i], i))
        index.setdefault(window[at], []).append((at, list(window), sorted(ids)))
    return index


def match(words: list[bytes], index: dict) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged hit spans (word numbers, end exclusive) and the items that occur."""
    spans, ids, n = [], set(), len(words)
    for i, w in enumerate(words):
        if w in index:
            for at, window, owners in index[w]:
                start = i - at
                if start >= 0 and start + len(window) <= n \
                        and words[start] == window[0] and words[start:start + len(window)] == window:
                    spans.append((start, start + len(window)))
                    ids.update(owners)
    return merge(spans), ids


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def find_windows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text",
                 slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Add ``n_words``, ``hit_spans`` and ``item_ids`` (sorted) to every row.

    The benchmark is cut by its size into slices that fit in memory, one pass
    over the documents each; the passes add up, so the result is whole at any
    size.  Null texts have no words, items without words no windows; an item
    without id counts as ''.  Item rows that share an id are one item.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"),
                             F.col(item_text).alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, math.ceil(total / slice_bytes))
    clash = {"n_words", "hit_spans", "item_ids"}
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in clash])
    for part in range(slices):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(slices)) == part).collect()
        words = [(r["id"], words_of(r["text"])) for r in rows]
        vocabulary = spark.sparkContext.broadcast(frozenset(w for _, ws in words for w in ws))
        counts = {bytes(r["word"]): r["n"]
                  for r in word_counts(docs, vocabulary, text_col).collect()}
        out = _pass(out, spark.sparkContext.broadcast(build_index(words, counts)), text_col, part > 0)
        if part + 1 < slices:
            out = written(out, "decontaminate")
    return out


def _pass(docs: DataFrame, shared, text_col: str, more: bool) -> DataFrame:
    fields = [T.StructField("n_words", T.LongType()), T.StructField("hit_spans", SPANS),
              T.StructField("item_ids", T.ArrayType(T.StringType()))]
    if more:
        docs = (docs.withColumnRenamed("hit_spans", "mk_spans").withColumnRenamed("item_ids", "mk_ids"))

    def make():
        index = shared.value

        def fn(texts, old_spans=None, old_ids=None):
            n, spans, ids = [], [], []
            for k, t in enumerate(texts):
                words = words_of(t)
                s, found = match(words, index)
                if more:
                    s = merge(s + [(x["start"], x["end"]) for x in old_spans[k]])
                    found |= set(old_ids[k])
                n.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in s])
                ids.append(sorted(found))
            return [n, spans, ids]
        return fn

    out = map_text(docs, make, fields, text_col, ["mk_spans", "mk_ids"] if more else None)
    return out.drop("mk_spans", "mk_ids") if more else out


def verdicts(found: DataFrame, *keep: str) -> DataFrame:
    """Counts, a digest of the items, and whether a twentieth of the words is hit."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return (found.select(*keep, "n_words", n_hit.alias("n_hit"),
                         F.size("item_ids").cast("long").alias("n_items"),
                         F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))
