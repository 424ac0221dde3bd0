"""Sources and sinks: CSV round trip, catalog table, preview, spreading, session SQL."""

from pyspark.sql import functions as F

from modelyard.sources.tables import (cast_like, load_table, preview, read_csv, read_table,
                                      spread, write_csv)

from .conftest import SF_SMALL


def test_csv_roundtrip_with_and_without_schema(spark, tmp_path):
    cust = load_table(spark, SF_SMALL, "customer")
    path = write_csv(cust, str(tmp_path / "c"))
    inferred = read_csv(spark, path)
    assert dict(inferred.dtypes)["c_custkey"] == "int"        # inference narrows bigint
    back = cast_like(inferred, cust.schema).select(*cust.columns)
    assert back.exceptAll(cust).count() == 0 and cust.exceptAll(back).count() == 0
    typed = read_csv(spark, path, schema=cust.schema)          # no inference pass
    assert typed.schema == cust.schema


def test_catalog_table_roundtrip(spark, tmp_path):
    nation = load_table(spark, SF_SMALL, "nation")
    nation.write.mode("overwrite").option("path", str(tmp_path / "n")).saveAsTable("t_nation")
    assert read_table(spark, "t_nation").exceptAll(nation).count() == 0


def test_preview_is_top_k_with_cut_strings(spark):
    o = load_table(spark, SF_SMALL, "orders")
    p = preview(o, ["o_orderkey"], n=5, truncate=3).collect()
    assert len(p) == 5
    assert [r["o_orderkey"] for r in p] == sorted(r["o_orderkey"] for r in p)
    assert all(len(r["o_orderpriority"]) <= 3 for r in p)
    whole = preview(o, ["o_orderkey"], n=5, truncate=None).collect()
    assert any(len(r["o_orderpriority"]) > 3 for r in whole)


def test_spread_keeps_rows_and_skips_large_inputs(spark):
    small = spark.range(100)
    assert spread(small) is small                      # below the size threshold
    wide = spark.range(50000).select("id", F.lit("x" * 200).alias("pad")).coalesce(1)
    out = spread(wide, min_bytes=1)
    assert out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert out.count() == 50000
    many = spark.range(1000).repartition(16)
    assert spread(many, min_bytes=1) is many           # already enough splits


def test_session_sql_with_dataframe_argument(spark):
    li = load_table(spark, SF_SMALL, "lineitem")
    n = spark.sql("SELECT count(*) AS n FROM {li} WHERE l_quantity > 10", li=li).first()["n"]
    assert n == li.where("l_quantity > 10").count()


def test_reads_and_writes_on_a_store_only_spark_reaches(spark, tmp_path):
    """Object-store paths go through the session's Hadoop settings, like fs.s3a.* ones."""
    from modelyard.sources.tables import save_table
    name = "fs.viewfs.mounttable.bucket.link./data"
    spark.conf.set(name, f"file://{tmp_path}")
    try:
        cust = load_table(spark, SF_SMALL, "customer")
        uri = "viewfs://bucket/data/customer-csv"
        assert write_csv(cust, uri) == uri
        back = cast_like(read_csv(spark, uri), cust.schema).select(*cust.columns)
        assert back.exceptAll(cust).count() == 0 and cust.exceptAll(back).count() == 0
        cust.write.parquet("viewfs://bucket/data/sf/customer.parquet")
        assert load_table(spark, "viewfs://bucket/data/sf/", "customer").count() == cust.count()
        assert (tmp_path / "customer-csv").is_dir()
        assert read_table(spark, save_table(cust, "t_stored", path=str(tmp_path / "t"))).count() == cust.count()
    finally:
        spark.conf.unset(name)
