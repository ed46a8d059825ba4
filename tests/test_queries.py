"""Every registered query against its SQL, and the shape of their plans."""

import pytest
from conftest import SF_DIR, plan_of
from pyspark.sql import functions as F

import __spark_entry__
import workload
from workload.check import compare, connect
from workload.fixtures import part_items, part_pages


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", workload.QUERIES)
def test_query_agrees_with_sql(spark, con, name):
    problem = compare(spark, con, SF_DIR, name)
    # The smallest tables may leave a difference empty; the larger ones do not.
    assert problem in ("", "both empty")


@pytest.mark.parametrize("name", workload.QUERIES)
def test_plan_stays_in_the_jvm(spark, name):
    plan = plan_of(workload.QUERIES[name](spark, SF_DIR))
    for node in ("PythonUDF", "EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["estado", "n_listings", "n_priced", "mean_price"] and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_one_row_group_of_parts_is_parsed_by_many_tasks(spark, tmp_path):
    columns = "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int, p_retailprice double"
    parts = [(k if k < 2000 else None, "a", "b", "c", 1, 2.0) for k in range(2010)]
    spark.createDataFrame(parts, columns).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    cores = spark.sparkContext.defaultParallelism
    for rows, n in ((part_items(spark, str(tmp_path)), 2010), (part_pages(spark, str(tmp_path)), 85)):
        tasks = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == n and len(tasks) > cores and max(tasks) < n / cores


def test_partitioned_table_parses_once(spark, monkeypatch):
    from workload import listings

    plans, write = [], listings.write_listings
    monkeypatch.setattr(listings, "write_listings", lambda df, path: (plans.append(plan_of(df)), write(df, path)))
    assert workload.QUERIES["S8_partitioned_table"](spark, SF_DIR).count() > 0
    # The writer runs its input twice, so the items must have been parsed by then.
    assert len(plans) == 1 and "Generate" not in plans[0] and "Scan parquet" in plans[0]
