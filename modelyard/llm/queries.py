"""The registered queries of the training-data operators, one each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import register
from ..sources.tables import load_table
from . import (bpe, chosen_path, decontaminate, hash_tree, line_dedup, nbsvm, periodic_runs, phrases,
               ppm_language, quality_rules, secrets, token_counts, toxicity)
from .keys import fold

SHARDS = 16
TOKEN_LIMIT = 2048


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op1_line_dedup", "LLM1")
def op1_line_dedup(spark, sf_dir):
    """The deduplicated text of every document."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


@register("op2_bpe", "LLM2")
def op2_bpe(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode_decode(docs, vocabulary("word_bpe_49k.json")), "doc_id")


OP3_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM d),
win AS (SELECT doc_id, t, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
grams AS (SELECT doc_id, t, i, array_to_string(ws[i:i + 4], ' ') AS g FROM win),
again AS (SELECT doc_id, t, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t, g) AS n FROM grams)
          WHERE n > 1),
covered AS (SELECT doc_id, t, count(DISTINCT p) AS n FROM
            (SELECT doc_id, t, unnest(range(i, i + 5)) AS p FROM again) GROUP BY ALL),
lines AS (SELECT doc_id, t, host, unnest(string_split(t, chr(10))) AS line FROM w),
per AS (SELECT doc_id, t, host, trim(regexp_replace(lower(line), '[^\p{L}\p{N}]+', ' ', 'g')) AS l,
               sum(len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS n
        FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
common AS (SELECT host, l FROM per GROUP BY host, l HAVING count(*) > 10),
gone AS (SELECT doc_id, t, sum(n) AS n FROM per JOIN common USING (host, l) GROUP BY ALL),
base AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words,
           length(regexp_replace(w.t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
           (length(w.t) - length(regexp_replace(w.t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
           coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
           coalesce(gone.n, 0)::BIGINT AS n_removed_words
         FROM w LEFT JOIN covered USING (doc_id, t) LEFT JOIN gone USING (doc_id, t)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words,
       NOT base_failed AND n_words - n_removed_words >= 10
         AND 100 * (n_words - n_removed_words) >= 50 * n_words AS kept
FROM judged
"""


@register("op3_quality_rules", "LLM3", OP3_SQL)
def op3_quality_rules(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality_rules.quality_rules(docs).drop("text", "source")


@register("op4_jaccard_join", "LLM4")
def op4_jaccard_join(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return chosen_path.jaccard_classes(docs).select("doc_id", "class_id", "n_links")


@register("op5_quality_classifier", "LLM5")
def op5_quality_classifier(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load_table(spark, sf_dir, "labels")
    from .labelled import training_rows
    model = nbsvm.fit(training_rows(docs, labels, "quality", fold("doc_id", 3) != 1))
    return nbsvm.predict(docs, model).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))


@register("op6_toxicity", "LLM6")
def op6_toxicity(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load_table(spark, sf_dir, "labels")
    from .labelled import training_rows
    part = fold("doc_id", 5)
    # Fold 4 sets the scale of the probabilities, folds 1 to 3 are counted.
    model = toxicity.fit(training_rows(docs, labels, "toxic", part.isin(1, 2, 3)),
                         training_rows(docs, labels, "toxic", part == 4))
    return toxicity.predict(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))


@register("op7_hash_tree_shards", "LLM7")
def op7_hash_tree_shards(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    placed = hash_tree.place(sized, hash_tree.layout(SHARDS), "doc_id")
    grown = hash_tree.place(placed, hash_tree.layout(SHARDS + 1), "doc_id", "grown_shard")
    return hash_tree.slots(grown, ["doc_id", "text_crc32", "size"])


@register("op8_language_id", "LLM8")
def op8_language_id(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = ppm_language.fit(docs.where(fold("doc_id", 5) != 0))
    return ppm_language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@register("op9_secrets", "LLM9")
def op9_secrets(spark, sf_dir):
    import public_tokenizers
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.report(secrets.find_secrets(
        docs, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN), "doc_id")


OP10_SQL = r"""
WITH d AS (SELECT doc_id, text, list_filter(string_split_regex(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS id, list_filter(string_split_regex(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
bi AS (SELECT id, ws, least(13, len(ws)) AS k, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i
       FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT id, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM bi),
sizes AS (SELECT DISTINCT k FROM win),
dk AS (SELECT doc_id, text, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, sizes WHERE len(ws) >= k),
hit AS (SELECT doc_id, text, dk.k, i, id FROM (SELECT *, array_to_string(ws[i:i + k - 1], ' ') AS g FROM dk) dk
        JOIN win ON win.g = dk.g AND win.k = dk.k),
pos AS (SELECT doc_id, text, count(DISTINCT p) AS n FROM
        (SELECT doc_id, text, unnest(range(i, i + k)) AS p FROM hit) GROUP BY ALL),
ids AS (SELECT doc_id, text, count(*) AS n, string_agg(id, ',' ORDER BY id) AS s FROM
        (SELECT DISTINCT doc_id, text, id FROM hit) GROUP BY ALL)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(pos.n, 0)::BIGINT AS n_hit,
       coalesce(ids.n, 0)::BIGINT AS n_items, sha256(coalesce(ids.s, '')) AS items_sha256,
       coalesce(pos.n, 0) > 0 AND 20 * coalesce(pos.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN pos USING (doc_id, text) LEFT JOIN ids USING (doc_id, text)
"""


@register("op10_decontaminate", "LLM10", OP10_SQL)
def op10_decontaminate(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    bench = load_table(spark, sf_dir, "benchmark")
    return decontaminate.verdicts(decontaminate.find_windows(docs, bench), "doc_id")


@register("op11_periodic_runs", "LLM11")
def op11_periodic_runs(spark, sf_dir):
    """Runs of every document, those whose hash ends in 0 with a looped tail."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.report(periodic_runs.periodic_runs(periodic_runs.looped_texts(docs)), "doc_id")


OP12_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0),
totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
grams AS (SELECT lang, ws, i, unnest([1, 2, 3, 4]) AS k FROM starts),
f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS a
      FROM grams WHERE i + k - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, phrase, k, a, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS c FROM f WHERE k >= 2),
both_parts AS (SELECT cuts.*, x.a AS l, y.a AS r, (2000000::HUGEINT * cuts.a) // (x.a + y.a) AS score
          FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(ws[1:c], ' ')
                    JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(ws[c + 1:cuts.k], ' ')),
cand AS (SELECT * FROM both_parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
sizes AS (SELECT lang, a, ws, k, unnest(range(2, k)) AS m FROM cand WHERE k >= 3),
subs AS (SELECT lang, a, ws, m, unnest(range(1, k - m + 2)) AS i FROM sizes),
inner_max AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS f FROM subs GROUP BY ALL),
kept AS (SELECT cand.* FROM cand LEFT JOIN inner_max USING (lang, phrase)
         WHERE inner_max.f IS NULL OR 100::HUGEINT * inner_max.f < 80::HUGEINT * cand.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@register("op12_phrases", "LLM12", OP12_SQL)
def op12_phrases(spark, sf_dir):
    """The best collocations of every language."""
    return phrases.collocations(load_table(spark, sf_dir, "documents").select("text", "lang"))


@register("op13_token_counts", "LLM13")
def op13_token_counts(spark, sf_dir):
    """Tokens of every document and whether they pass the limit."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, vocabulary("word_bpe_49k.json"))
    return token_counts.limits(counted, TOKEN_LIMIT).select("doc_id", "n_bytes", "n_tokens", "over_limit")
