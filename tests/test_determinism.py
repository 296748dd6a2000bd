"""Results do not depend on the partitioning: exact means and key tiebreaks
make every registered query's output identical under different shuffle
partition counts (and so across reruns and retried tasks)."""

import pytest

from tempora.plans import catalog
from tests.conftest import SF_SMALL

KEYS = ["yearly_mean", "mean_by_country", "hottest", "coldest", "hottest_ref", "coldest_ref", "global_stats",
        "extremes_high", "evolution",
        "rank_by_mean", "latest_per_key", "stats_per_key", "normalise_routed", "run_report"]


def _rows(spark, key, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = catalog.QUERIES[key](spark, SF_SMALL)
        return sorted((tuple(r) for r in df.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("key", KEYS)
def test_same_result_under_any_partitioning(spark, key):
    assert _rows(spark, key, 1) == _rows(spark, key, 13)
