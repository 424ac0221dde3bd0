"""Splits, folds and the distributed row index."""

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from modelyard.functions.ids import threshold
from modelyard.operators.index import row_index, running_sum
from modelyard.operators.split import (hash_split, hash_split_col, kfold_col, random_split,
                                       stratified_holdout, stratified_kfold)


def _ids(spark, n, parts=3):
    return spark.range(n).repartition(parts).withColumnRenamed("id", "k")


def test_thresholds():
    assert threshold(0.0) == 0
    assert threshold(0.5) == 1 << 30
    assert threshold(1.0) == 1 << 31   # above every hash value


def test_key_hash_range_and_uniformity(spark):
    from modelyard.functions.ids import key_hash
    df = spark.range(20000).select(key_hash(["id"], 5).alias("h"))
    r = df.agg(F.min("h"), F.max("h"), F.avg("h")).first()
    assert r[0] >= 0 and r[1] < (1 << 31)
    assert abs(r[2] / (1 << 30) - 1) < 0.02


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=0.05, max_value=5), min_size=2, max_size=4))
def test_hash_split_disjoint_and_covers(spark, weights):
    df = _ids(spark, 500)
    parts = hash_split(df, ["k"], weights, seed=3)
    counts = [p.count() for p in parts]
    assert sum(counts) == 500
    union = parts[0]
    for p in parts[1:]:
        union = union.union(p)
    assert union.distinct().count() == 500


def test_hash_split_stable_under_repartition(spark):
    a = _ids(spark, 2000, 2).select("k", hash_split_col(["k"], [0.8, 0.2], 1).alias("s"))
    b = _ids(spark, 2000, 7).select("k", hash_split_col(["k"], [0.8, 0.2], 1).alias("s"))
    diff = a.join(b.withColumnRenamed("s", "s2"), "k").where("s <> s2").count()
    assert diff == 0
    share = a.where("s = 0").count() / 2000
    assert 0.75 < share < 0.85


def test_random_split_covers(spark):
    df = _ids(spark, 1000)
    parts = random_split(df, [0.8, 0.2], 1)
    assert sum(p.count() for p in parts) == 1000


def test_kfold_range_and_balance(spark):
    df = _ids(spark, 5000).select(kfold_col(["k"], 5, 1).alias("f"))
    counts = {r["f"]: r["count"] for r in df.groupBy("f").count().collect()}
    assert set(counts) == {0, 1, 2, 3, 4}
    assert min(counts.values()) > 800


def test_stratified_folds_differ_by_at_most_one(spark):
    rows = [(i, 1 if i % 10 else 0) for i in range(203)]
    df = spark.createDataFrame(rows, "k long, y int").repartition(4)
    out = stratified_kfold(df, "y", ["k"], k=5).groupBy("y", "fold").count().toPandas()
    for _, g in out.groupby("y"):
        assert g["count"].max() - g["count"].min() <= 1
        assert len(g) == 5


def test_stratified_holdout_exact_share(spark):
    rows = [(i, 1 if i < 90 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "k long, y int")
    out = stratified_holdout(df, "y", ["k"], 0.7).groupBy("y", "split").count().toPandas()
    got = {(r.y, r.split): r["count"] for _, r in out.iterrows()}
    assert got[(1, 0)] == 63 and got[(1, 1)] == 27
    assert got[(0, 0)] == 7 and got[(0, 1)] == 3


def test_stratified_single_class(spark):
    df = spark.createDataFrame([(i, 1) for i in range(10)], "k long, y int")
    out = stratified_holdout(df, "y", ["k"], 0.7)
    assert out.where("split = 0").count() == 7


def test_row_index_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(5)
    out = row_index(df, ["k"], num_partitions=6).toPandas().sort_values("k")
    assert list(out["row_idx"]) == list(range(1000))
    assert list(out["k"]) == list(range(1000))


def test_row_index_grouped_with_hot_group(spark):
    # one group holds 90% of the rows: it is still numbered across partitions
    rows = [(i, "hot" if i % 10 else f"g{i % 3}") for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, g string").repartition(3)
    out = row_index(df, ["k"], group_cols=["g"], group_size="n", num_partitions=8).toPandas()
    for g, part in out.groupby("g"):
        part = part.sort_values("k")
        assert list(part["row_idx"]) == list(range(len(part)))
        assert (part["n"] == len(part)).all()


def test_running_sum_matches_pandas(spark):
    rows = [(i % 3, i, float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, k long, v double").repartition(4)
    out = running_sum(df, ["v"], ["k"], group_cols=["g"], num_partitions=5).toPandas()
    pdf = pd.DataFrame(rows, columns=["g", "k", "v"]).sort_values(["g", "k"])
    pdf["cum_v"] = pdf.groupby("g")["v"].cumsum()
    merged = out.merge(pdf, on=["g", "k"], suffixes=("", "_pd"))
    assert (merged["cum_v"] == merged["cum_v_pd"]).all()
    assert len(merged) == 300


def test_running_sum_pandas_and_window_agree_across_batches(spark):
    # small Arrow batches force carries across batch boundaries
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(("hot" if i % 5 else "cold"), i, i % 4) for i in range(500)]
        df = spark.createDataFrame(rows, "g string, k long, v long").repartition(3)
        a = running_sum(df, ["v"], [F.col("k").desc()], group_cols=["g"], num_partitions=4,
                        method="pandas").toPandas()
        b = running_sum(df, ["v"], [F.col("k").desc()], group_cols=["g"], num_partitions=4,
                        method="window").toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    m = a.merge(b, on=["g", "k", "v"], suffixes=("_p", "_w"))
    assert len(m) == 500 and (m["cum_v_p"] == m["cum_v_w"]).all()
    pdf = pd.DataFrame(rows, columns=["g", "k", "v"]).sort_values(["g", "k"], ascending=[True, False])
    pdf["cum_v"] = pdf.groupby("g")["v"].cumsum()
    m2 = a.merge(pdf, on=["g", "k"], suffixes=("", "_pd"))
    assert (m2["cum_v"] == m2["cum_v_pd"]).all()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-(2 ** 63), 2 ** 63 - 1), st.integers(-(2 ** 31), 2 ** 31 - 1)),
                min_size=1, max_size=40),
       st.sampled_from([1, 7, "fold", "x|y"]))
def test_key_hash_equal_in_spark_and_duckdb(spark, rows, seed):
    """Full signed 64-bit range, negatives included: no overflow, same values."""
    import duckdb
    from modelyard.functions.ids import key_hash, key_hash_sql
    df = spark.createDataFrame(rows, "a long, b int")
    got = sorted((r["a"], r["b"], r["h"]) for r in df.select("a", "b", key_hash(["a", "b"], seed).alias("h")).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE t (a BIGINT, b INTEGER)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    want = sorted(con.sql(f"SELECT a, b, {key_hash_sql(['a', 'b'], seed)} AS h FROM t").fetchall())
    assert got == want
    assert all(0 <= h < (1 << 31) for _, _, h in got)


def test_null_class_rows_stay(spark):
    from modelyard.operators.index import row_index
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None)], "k int, c string")
    got = row_index(df, ["k"], group_cols=["c"], out="i").collect()
    assert sorted((r["k"], r["i"]) for r in got) == [(1, 0), (2, 0), (3, 1), (4, 1)]
