"""Zone sinks and scans: directory layout, types, in-file order, no single-task writes."""

import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from revmart.operators.conform import add_partition_keys
from revmart.plans import catalog
from revmart.schemas import BRONZE_FILE_ORDER, BRONZE_PARTITIONS, BRONZE_SCHEMA, LANDING_SCHEMA
from revmart.session import scratch_path
from revmart.sources.zones import layout_for_write, read_landing, read_zone, write_zone


def test_landing_keys_written_as_text_read_as_int(spark, sf001):
    path = scratch_path(spark, "t-landing")
    write_zone(add_partition_keys(catalog.rv(spark, sf001)), path, ["ano", "mes"])
    dirs = sorted(os.path.relpath(d, path) for d in glob.glob(f"{path}/ano=*/mes=*"))
    assert dirs == ["ano=2022/mes=06", "ano=2022/mes=07"]
    back = read_landing(spark, path)
    assert dict(back.dtypes)["mes"] == "int"
    assert sorted(r.mes for r in back.select("mes").distinct().collect()) == [6, 7]


def test_bronze_layout_and_in_file_order(spark, sf001):
    path = scratch_path(spark, "t-bronze")
    bronze = catalog.rv_bronze(spark, sf001)
    write_zone(bronze, path, BRONZE_PARTITIONS, BRONZE_FILE_ORDER)
    assert sorted(os.path.relpath(d, path) for d in glob.glob(f"{path}/pt_ano=*/pt_mes=*")) == [
        "pt_ano=2022/pt_mes=6", "pt_ano=2022/pt_mes=7",
    ]
    back = read_zone(spark, path, BRONZE_SCHEMA)
    assert back.exceptAll(bronze).count() == 0 and bronze.exceptAll(back).count() == 0
    for f in glob.glob(f"{path}/*/*/*.parquet"):
        t = pq.read_table(f, columns=BRONZE_FILE_ORDER).to_pylist()
        keys = [tuple("" if v is None else str(v) for v in r.values()) for r in t]
        assert keys == sorted(keys)


def test_write_layout_never_single_task(spark, sf001):
    bronze = catalog.rv_bronze(spark, sf001)
    plan = layout_for_write(bronze, BRONZE_PARTITIONS, BRONZE_FILE_ORDER)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "SinglePartition" not in plan


def test_silver_write_has_no_shuffle(spark, sf001):
    from revmart.operators.conform import stamp_load_time

    path = scratch_path(spark, "t-bronze2")
    write_zone(catalog.rv_bronze(spark, sf001), path, BRONZE_PARTITIONS, BRONZE_FILE_ORDER)
    silver = stamp_load_time(read_zone(spark, path, BRONZE_SCHEMA))
    plan = layout_for_write(silver, BRONZE_PARTITIONS, BRONZE_FILE_ORDER, files="keep")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_month_filter_prunes_partitions(spark, sf001):
    from revmart.functions.dates import month_filter

    path = scratch_path(spark, "t-bronze3")
    write_zone(catalog.rv_bronze(spark, sf001), path, BRONZE_PARTITIONS)
    df = month_filter(read_zone(spark, path, BRONZE_SCHEMA), "dt_date", "2022-06", ("pt_ano", "pt_mes"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(" in plan
    assert "GreaterThanOrEqual(dt_date" in plan
    # July's directory is not read at all
    assert all("pt_mes=6" in f for f in df.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    assert df.where(F.col("pt_mes") != 6).count() == 0


def test_file_count_per_directory(spark, sf001):
    bronze = catalog.rv_bronze(spark, sf001)
    rebalanced = scratch_path(spark, "t-files")
    write_zone(bronze, rebalanced, BRONZE_PARTITIONS, BRONZE_FILE_ORDER)
    for d in glob.glob(f"{rebalanced}/pt_ano=*/pt_mes=*"):
        assert len(glob.glob(f"{d}/*.parquet")) == 1  # small month: one writer
    one = scratch_path(spark, "t-coalesce")
    write_zone(bronze, one, BRONZE_PARTITIONS, files=1)
    assert len(glob.glob(f"{one}/*/*/*.parquet")) == 2


def test_write_reports_rows_without_a_second_pass(spark, sf001):
    bronze = catalog.rv_bronze(spark, sf001)
    written = write_zone(bronze, scratch_path(spark, "t-observe"), BRONZE_PARTITIONS, BRONZE_FILE_ORDER)
    assert written.rows == spark.read.parquet(f"{sf001}/documents.parquet").count()
    assert os.path.isdir(written.path)


def test_silver_stamp_is_a_standard_parquet_timestamp(spark, sf001):
    from revmart.operators.conform import stamp_load_time

    path = scratch_path(spark, "t-ts")
    write_zone(stamp_load_time(catalog.rv_bronze(spark, sf001)), path, BRONZE_PARTITIONS)
    f = glob.glob(f"{path}/*/*/*.parquet")[0]
    col = pq.ParquetFile(f).schema.column(pq.ParquetFile(f).schema_arrow.get_field_index("ts_gravado_em"))
    assert col.physical_type == "INT64"  # TIMESTAMP_MICROS, not legacy INT96
