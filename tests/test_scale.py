"""Scale properties of the plans: skew-safe aggregates and writers."""

import glob
import re

from pyspark.sql import functions as F

from revmart.operators.aggregate import gold_mart
from revmart.operators.conform import dedup
from revmart.plans import catalog
from revmart.schemas import BRONZE_FILE_ORDER, BRONZE_PARTITIONS
from revmart.session import scratch_path
from revmart.sources.zones import write_zone


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_first_exchange_spreads_a_group_by_id(spark, sf001):
    plan = _plan(gold_mart(spark.read.parquet(f"{sf001}/lineitem.parquet"),
                           "l_quantity", "l_returnflag", "l_partkey", "l_shipdate"))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2
    assert any("l_partkey" in line for line in exchanges)  # (month, version, id)
    assert "partial_avg" in plan and "partial_count(distinct" in plan


def test_dedup_combines_copies_before_the_shuffle(spark):
    df = spark.range(0, 30000).select((F.col("id") % 3 == 0).cast("int").alias("hot"), "id")
    copies = df.select(F.when(F.col("hot") == 1, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    plan = _plan(dedup(copies))
    before_exchange = plan.split("Exchange")[1]
    assert "HashAggregate" in before_exchange  # partial aggregate below the exchange
    assert dedup(copies).count() == 20001


def test_hot_month_is_split_over_writers(spark, sf001):
    rv = catalog.rv_bronze(spark, sf001)
    # nine copies of June under distinct ids: June holds ~90% of the rows
    june = rv.where(F.col("pt_mes") == 6)
    hot = rv.unionByName(june.withColumn("nu_id", F.concat(F.col("nu_id"), F.lit("-"), F.lit(1))))
    for i in range(2, 10):
        hot = hot.unionByName(june.withColumn("nu_id", F.concat(F.col("nu_id"), F.lit("-"), F.lit(i))))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(256 * 1024))
    try:
        path = scratch_path(spark, "t-hot")
        written = write_zone(hot, path, BRONZE_PARTITIONS, BRONZE_FILE_ORDER)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    june_files = glob.glob(f"{path}/pt_ano=2022/pt_mes=6/*.parquet")
    july_files = glob.glob(f"{path}/pt_ano=2022/pt_mes=7/*.parquet")
    assert len(june_files) > 1  # the hot directory got several writers
    assert len(july_files) >= 1
    assert written.rows == hot.count()


def test_no_scale_red_flags_in_any_registered_plan(spark, sf001):
    never = ["BroadcastExchange", "BroadcastHashJoin", "Cartesian", "BatchEvalPython", "Window", "CollectLimit"]
    for name, fn in catalog.QUERIES.items():
        plan = _plan(fn(spark, sf001))
        assert not [f for f in never if f in plan], name
        if "SinglePartition" in plan:
            # only the derived feed's scalar max(doc_id div 50): one partial row per map task
            assert name.startswith("feed_") or name == "landing_count_by_year_month", name
            assert re.search(r"max\(+doc_id div 50\)+", plan), name
