"""Plan shape checks: pruning and pushdown reach the scan, top-k is fused,
no Python evaluation, one scan per batch job."""

from tempora.operators import analysis, clean
from tempora.plans import catalog, tables
from tempora.sinks.files import write_clean
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_anywhere(spark):
    for key, fn in catalog.QUERIES.items():
        if key.startswith(("stream", "unified", "source", "distinct", "recent", "roundtrip")):
            continue
        p = plan(fn(spark, SF_SMALL))
        assert "Python" not in p, key


def test_column_pruning_on_scan(spark):
    p = plan(catalog.mean_by_year(spark, SF_SMALL))
    scan = [line for line in p.splitlines() if "FileScan" in line][0]
    assert "o_totalprice" in scan and "o_orderdate" in scan
    assert "o_orderstatus" not in scan.split("ReadSchema")[1]


def test_top_k_is_take_ordered(spark):
    for fn in (catalog.hottest, catalog.mean_by_country, catalog.extremes_high):
        assert "TakeOrderedAndProject" in plan(fn(spark, SF_SMALL))


def test_hottest_and_coldest_share_one_aggregate_shape(spark):
    p = plan(catalog.hottest(spark, SF_SMALL))
    assert p.count("HashAggregate") == 2  # partial + final, no sort of detail rows


def test_partition_pruning_on_year(spark, tmp_path):
    path = str(tmp_path / "clean")
    write_clean(clean.clean_history(tables.history_from_orders(spark, SF_SMALL)), path)
    df = spark.read.parquet(path)
    p = plan(analysis.mean_by_year(df.filter("year >= 2000")))
    assert "PartitionFilters: [isnotnull(year" in p and "(year" in p and ">= 2000" in p


def test_filter_pushed_to_parquet(spark, tmp_path):
    path = str(tmp_path / "clean")
    write_clean(clean.clean_history(tables.history_from_orders(spark, SF_SMALL)), path)
    df = spark.read.parquet(path)
    p = plan(analysis.extremes(df, 5000.0, 495000.0))
    assert "PushedFilters: [Or(LessThan(temperature,5000.0),GreaterThan(temperature,495000.0))]" in p


def test_batch_job_single_scan(spark):
    parsed = clean.parse_history(tables.history_from_orders(spark, SF_SMALL))
    p = plan(analysis.yearly_means(parsed))
    assert p.count("FileScan") == 1


def test_distinct_counts_one_job(spark):
    from tempora.operators.unified import distinct_counts
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").selectExpr("cast(o_custkey as string) City",
                                                                     "o_orderpriority Country")
    p = plan(distinct_counts(df))
    assert p.count("FileScan") == 1 and "Expand" in p


def test_spread_is_noop_when_input_is_split(spark):
    from tempora.operators.partitioning import spread

    many = spark.range(0, 1000, numPartitions=16)
    assert spread(many) is many
    few = spark.range(0, 1000, numPartitions=1)
    spread_plan = plan(spread(few))
    assert "hashpartitioning(xxhash64" in spread_plan


def test_hot_year_is_split_over_several_files(spark, tmp_path):
    import os

    from pyspark.sql import functions as F

    from tempora.sinks.files import write_partitioned

    hot = spark.range(0, 200_000, numPartitions=8).select(
        F.when(F.col("id") % 100 > 0, F.lit(2000)).otherwise(F.lit(1990) + (F.col("id") / 100).cast("long") % 5)
        .alias("year"),
        (F.col("id") * 1.5).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_partitioned(hot, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot_files = [f for f in os.listdir(tmp_path / "out" / "year=2000") if f.endswith(".parquet")]
    cold_dirs = [d for d in os.listdir(tmp_path / "out") if d.startswith("year=") and d != "year=2000"]
    cold_files = [len([f for f in os.listdir(tmp_path / "out" / d) if f.endswith(".parquet")]) for d in cold_dirs]
    assert len(hot_files) > 1  # the dominant year is written by several tasks
    assert cold_dirs and all(n == 1 for n in cold_files)  # small years stay one file each
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200_000


def test_unified_roots_both_pruned_by_year(spark):
    p = plan(catalog.recent_top5(spark, SF_SMALL))
    scans = [line for line in p.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert all("PartitionFilters: [isnotnull(year" in s and ">= 2000" in s for s in scans)


def test_no_cross_joins_or_python_in_any_query(spark):
    for key, fn in catalog.QUERIES.items():
        p = plan(fn(spark, SF_SMALL))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in p, (key, bad)
