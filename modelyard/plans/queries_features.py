"""Registered queries: feature types, levels, problem kind, imputation, one-hot."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ids import hash_below, hash_below_sql
from ..functions.numeric import round_sig, round_sig_sql
from ..operators.features import (apply_imputer, domain_values, feature_types, fit_imputer,
                                  fit_levels, one_hot, problem_kind)
from ..operators.split import hash_split_col, hash_split_sql
from ..registry import register
from ..sources.tables import load_table

R = round_sig_sql

# Part columns with their Spark type names.
PART_COLUMNS = [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"),
                ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")]

FEATURE_TYPES_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, "
    f"'{'categorical' if t == 'string' else 'numeric'}' AS kind, "
    f"count(DISTINCT {c}) AS n_distinct, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM part"
    for c, t in PART_COLUMNS)


@register("feature_types", "F2", FEATURE_TYPES_SQL)
def feature_types_q(spark, sf_dir):
    """Per column of part: type, kind, exact distinct count, null count."""
    part = load_table(spark, sf_dir, "part")
    return feature_types(part, exact=True).withColumnRenamed("column", "column_name")


DOMAIN_SQL = """
WITH s AS (SELECT 'c_mktsegment' AS column_name, c_mktsegment AS value FROM customer
           UNION ALL SELECT 'c_name', c_name FROM customer),
c AS (SELECT column_name, value, count(*) AS n FROM s WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT column_name, value, n,
       row_number() OVER (PARTITION BY column_name ORDER BY value) - 1 AS level
FROM c
"""


@register("domain_values", "F3", DOMAIN_SQL)
def domain_values_q(spark, sf_dir):
    """Sorted levels of the string columns of customer, in long form."""
    cust = load_table(spark, sf_dir, "customer")
    return domain_values(cust, ["c_mktsegment", "c_name"]).withColumnRenamed("column", "column_name")


PROBLEM_KIND_SQL = """
SELECT 'part' AS table_name, 'p_retailprice' AS label, 'double' AS dtype,
       count(DISTINCT p_retailprice) AS n_distinct, 'regression' AS kind FROM part
UNION ALL
SELECT 'labels', 'quality', 'int', count(DISTINCT quality),
       CASE WHEN count(DISTINCT quality) <= 2 THEN 'binomial'
            WHEN count(DISTINCT quality) <= 100 THEN 'multinomial' ELSE 'regression' END FROM labels
UNION ALL
SELECT 'embeddings', 'label', 'int', count(DISTINCT label),
       CASE WHEN count(DISTINCT label) <= 2 THEN 'binomial'
            WHEN count(DISTINCT label) <= 100 THEN 'multinomial' ELSE 'regression' END FROM embeddings
"""


@register("problem_kind", "F4", PROBLEM_KIND_SQL)
def problem_kind_q(spark, sf_dir):
    """Regression, binomial or multinomial for three labelled tables."""
    out = None
    for table, label in [("part", "p_retailprice"), ("labels", "quality"), ("embeddings", "label")]:
        k = problem_kind(load_table(spark, sf_dir, table), label).select(
            F.lit(table).alias("table_name"), "label", "dtype", "n_distinct", "kind")
        out = k if out is None else out.unionByName(k)
    return out


def nulled_customer(spark, sf_dir):
    """customer with ~15% of c_acctbal and c_mktsegment set null by a key-hash rule.

    The test tables hold no nulls, so imputation needs some; the rule keeps
    every row and is the same in any engine.
    """
    c = load_table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        F.when(hash_below(["c_custkey"], "na1", 0.15), F.lit(None)).otherwise(F.col("c_acctbal"))
        .alias("c_acctbal"),
        F.when(hash_below(["c_custkey"], "na2", 0.15), F.lit(None)).otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"))


_NULLED_CTE = f"""
nc AS (SELECT c_custkey,
              CASE WHEN {hash_below_sql(['c_custkey'], 'na1', 0.15)} THEN NULL ELSE c_acctbal END AS c_acctbal,
              CASE WHEN {hash_below_sql(['c_custkey'], 'na2', 0.15)} THEN NULL ELSE c_mktsegment END AS c_mktsegment
       FROM customer),
tr AS (SELECT * FROM nc WHERE {hash_split_sql(['c_custkey'], [0.8, 0.2], 1)} = 0)
"""

IMPUTE_SQL = f"""
WITH {_NULLED_CTE},
mu AS (SELECT avg(c_acctbal) AS m FROM tr),
md AS (SELECT c_mktsegment AS mode FROM tr WHERE c_mktsegment IS NOT NULL
       GROUP BY 1 ORDER BY count(*) DESC, c_mktsegment LIMIT 1)
SELECT c_custkey, {R('coalesce(c_acctbal, m)')} AS c_acctbal,
       CAST(c_acctbal IS NULL AS INTEGER) AS c_acctbal_was_null,
       coalesce(c_mktsegment, mode) AS c_mktsegment,
       CAST(c_mktsegment IS NULL AS INTEGER) AS c_mktsegment_was_null
FROM nc, mu, md
"""


@register("impute", "F5", IMPUTE_SQL)
def impute_q(spark, sf_dir):
    """Mean / mode imputation with statistics from the train rows only."""
    nc = nulled_customer(spark, sf_dir)
    train = nc.where(hash_split_col(["c_custkey"], [0.8, 0.2], 1) == 0)
    stats = fit_imputer(train, ["c_acctbal"], ["c_mktsegment"])
    out = apply_imputer(nc, stats, flag_suffix="_was_null")
    return out.withColumn("c_acctbal", round_sig("c_acctbal"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

ONE_HOT_SQL = "SELECT c_custkey, " + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS INTEGER) AS c_mktsegment_{s}" for s in SEGMENTS) + " FROM customer"


@register("one_hot", "F6", ONE_HOT_SQL)
def one_hot_q(spark, sf_dir):
    """One 0/1 column per market segment (levels from the train rows)."""
    cust = load_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    train = cust.where(hash_split_col(["c_custkey"], [0.8, 0.2], 1) == 0)
    levels = fit_levels(train, "c_mktsegment")
    return one_hot(cust, "c_mktsegment", levels)
