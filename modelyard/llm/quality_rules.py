"""Quality rules: repetition inside a document, line frequency across documents.

Everything is DataFrame expressions.  Lines are normalised and hashed, the
distinct documents of a host that hold a line are counted, lines above the
limit are removed, and a document that loses too much is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import row_key

# Fixed values of the base rules.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20        # percent of the words

MAX_DOCS_PER_HOST = 10    # a line in more documents of one host is boilerplate
LEAST_LEFT = 50           # percent of the words that must stay
_PLACE = 27               # bits of a sort key that hold a window's place


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def by_hash(windows: Column) -> Column:
    """Window places ordered by window hash: high bits the hash, low bits the place."""
    mask = (1 << _PLACE) - 1
    return F.sort_array(F.transform(windows, lambda h, i: h.bitwiseAND(F.lit(~mask)).bitwiseOR(
        i.cast("long").bitwiseAND(F.lit(mask)))))


def repeated_words(order: Column, windows: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in the text.

    ``order`` is ``by_hash(windows)`` as a column of its own: neighbours in it
    are compared by their whole hash.
    """
    mask = (1 << _PLACE) - 1

    def place(k: Column) -> Column:
        return F.get(order, k).bitwiseAND(F.lit(mask)).cast("int")

    def hashed(k: Column) -> Column:
        return F.get(windows, place(k))

    at = F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size(windows) - 1),
                 lambda k: F.coalesce(hashed(k) == hashed(k - 1), F.lit(False))
                 | F.coalesce(hashed(k) == hashed(k + 1), F.lit(False))), place))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(at, zero, lambda a, p: F.struct(
        (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")))["n"]


def base_columns(df: DataFrame, text_col: str) -> DataFrame:
    """Word, symbol, line and repetition counts of every row; null text: zeros."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    full = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    out = (df.withColumn("mk_text", text).withColumn("mk_words", words_of(text))
           .withColumn("mk_lines", full)
           .withColumn("n_words", F.size("mk_words").cast("long"))
           .withColumn("word_chars", F.length(F.regexp_replace("mk_text", SPACE, "")).cast("long"))
           .withColumn("n_symbols", (F.length("mk_text") - F.length(F.regexp_replace(
               "mk_text", SYMBOLS, ""))).cast("long"))
           .withColumn("n_dup_lines", (F.size("mk_lines") - F.size(F.array_distinct("mk_lines")))
                       .cast("long")))
    out = out.withColumn("mk_hashes", F.transform("mk_words", lambda w: F.xxhash64(w)))
    hashes = F.col("mk_hashes")
    windows = F.when(F.size(hashes) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - WINDOW),
        lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(WINDOW)])))
    out = out.withColumn("mk_windows", windows)
    again = F.size(F.array_distinct("mk_windows")) < F.size("mk_windows")
    out = out.withColumn("mk_order", F.when(again, by_hash(F.col("mk_windows"))))
    return out.withColumn("n_repeat_words", F.when(
        F.col("mk_order").isNotNull(), repeated_words(F.col("mk_order"), F.col("mk_windows")))
        .otherwise(F.lit(0)).cast("long")).drop(
        "mk_text", "mk_words", "mk_lines", "mk_hashes", "mk_windows", "mk_order")


def base_failed() -> Column:
    return ((F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def line_counts(df: DataFrame, text_col: str, host_col: str) -> DataFrame:
    """One row per document and different normalised line, with the words in it."""
    line = F.col("mk_line")
    return (df.select("mk_a", "mk_b", F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("mk_host"),
                      F.explode(F.split(F.col(text_col), "\n")).alias("mk_line"))
            .select("mk_a", "mk_b", "mk_host", F.xxhash64(normal(line)).alias("mk_hash"),
                    F.size(words_of(line)).cast("long").alias("mk_n"))
            .where("mk_n > 0")
            .groupBy("mk_host", "mk_hash", "mk_a", "mk_b").agg(F.sum("mk_n").alias("mk_n")))


def quality_rules(df: DataFrame, text_col: str = "text", host_col: str = "source",
                  doc_id: str = "doc_id", max_docs: int = MAX_DOCS_PER_HOST,
                  least_left: int = LEAST_LEFT) -> DataFrame:
    """Add the base counts, ``base_failed``, ``n_removed_words`` and ``kept``.

    A line is removed from the documents of a host when more than ``max_docs``
    different documents of that host hold it (normalised: lower case, runs of
    letters and digits).  ``kept`` is false when the base rules fail, when
    fewer than 10 words stay, or less than ``least_left`` percent of them.
    Rows equal in id and text count as one document; a null host is the host
    ''; null and empty texts have no words and fail.  No row is dropped.
    """
    a, b = row_key(doc_id, text_col)
    keyed = df.withColumn("mk_a", a).withColumn("mk_b", b)
    lines = line_counts(keyed, text_col, host_col)
    common = (lines.groupBy("mk_host", "mk_hash").agg(F.count("*").alias("mk_docs"))
              .where(F.col("mk_docs") > max_docs).select("mk_host", "mk_hash"))
    removed = (lines.join(common, ["mk_host", "mk_hash"])
               .groupBy(F.col("mk_a").alias("mk_ra"), F.col("mk_b").alias("mk_rb"))
               .agg(F.sum("mk_n").alias("mk_removed")))
    out = base_columns(keyed, text_col).withColumn("base_failed", base_failed())
    out = out.join(removed, (F.col("mk_a") == F.col("mk_ra")) & (F.col("mk_b") == F.col("mk_rb")), "left")
    left = F.col("n_words") - F.col("n_removed_words")
    return (out.withColumn("n_removed_words", F.coalesce("mk_removed", F.lit(0)).cast("long"))
            .withColumn("kept", ~F.col("base_failed") & (left >= LEAST_WORDS)
                        & (100 * left >= least_left * F.col("n_words")))
            .drop("mk_a", "mk_b", "mk_ra", "mk_rb", "mk_removed"))
