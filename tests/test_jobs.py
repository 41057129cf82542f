"""The four stages chained over scratch zones, checked with invariants."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from revmart.operators.aggregate import gold_mart
from revmart.operators.quality import count_by_year_month
from revmart.plans import catalog
from revmart.plans.jobs import run_stages
from revmart.plans.sql import DISTINCT_COUNT_BY_MONTH_SQL, gold_sql, run_on
from revmart.schemas import BRONZE_SCHEMA, GOLD_SCHEMA, LANDING_SCHEMA, SILVER_SCHEMA
from revmart.session import scratch_path
from revmart.sources.zones import read_landing, read_zone
from revmart.streaming import start_landing_stream


def test_pipeline_invariants(spark, sf001):
    load_ts = dt.datetime(2022, 8, 1, 3, 0, 0)
    paths = run_stages(spark, catalog.pages(spark, sf001), scratch_path(spark, "t-pipe"), load_ts)
    landing = read_landing(spark, paths["landing"])
    bronze = read_zone(spark, paths["bronze"], BRONZE_SCHEMA)
    silver = read_zone(spark, paths["silver"], SILVER_SCHEMA)
    gold = read_zone(spark, paths["gold"], GOLD_SCHEMA)
    docs = spark.read.parquet(f"{sf001}/documents.parquet").count()

    assert landing.count() == docs
    by_month = count_by_year_month(landing)
    assert by_month.agg(F.sum("count")).first()[0] == docs
    assert bronze.count() == bronze.distinct().count() == docs
    assert silver.drop("ts_gravado_em").exceptAll(bronze).count() == 0
    assert silver.where(F.col("ts_gravado_em") != F.lit(load_ts)).count() == 0
    assert gold.agg(F.sum("nu_quantidade_usuarios")).first()[0] == docs
    # the SQL mart on a view equals the DataFrame mart
    df_mart = gold_mart(silver)
    assert df_mart.exceptAll(gold.select(*df_mart.columns)).count() == 0
    silver.createOrReplaceTempView("vw_test_silver")
    assert spark.sql(gold_sql("vw_test_silver")).exceptAll(df_mart).count() == 0
    # distinct count per month over the silver view
    months = {r.data: r.total_registros for r in run_on(spark, DISTINCT_COUNT_BY_MONTH_SQL, silver).collect()}
    assert sum(months.values()) == docs and set(months) == {"2022-06", "2022-07"}
    for p in paths.values():
        assert os.path.isdir(p)


def test_stream_landing_is_incremental(spark, sf001):
    pages = catalog.pages(spark, sf001).withColumn("n", F.monotonically_increasing_id())
    first = pages.where(F.col("page_url").contains("page=0/")).drop("n")
    rest = pages.where(~F.col("page_url").contains("page=0/")).drop("n")
    landed, out, ckpt = (scratch_path(spark, n) for n in ("t-landed", "t-stream", "t-ckpt"))
    first.write.mode("append").parquet(landed)
    start_landing_stream(spark, landed, out, ckpt).awaitTermination()
    n_first = read_landing(spark, out).count()
    rest.write.mode("append").parquet(landed)
    start_landing_stream(spark, landed, out, ckpt).awaitTermination()
    total = read_landing(spark, out)
    docs = spark.read.parquet(f"{sf001}/documents.parquet").count()
    assert 0 < n_first < docs
    assert total.count() == docs and total.select("id").distinct().count() == docs


def test_quality_report_reads_the_silver_zone(spark, sf001):
    from revmart.plans.jobs import quality_report

    paths = run_stages(spark, catalog.pages(spark, sf001), scratch_path(spark, "t-pipe2"))
    report = quality_report(spark, paths["silver"])
    docs = spark.read.parquet(f"{sf001}/documents.parquet").count()
    for name in ("count_by_votes", "count_by_rating", "count_by_version", "distinct_count_by_month"):
        total = "total_registros" if name == "distinct_count_by_month" else "total"
        assert report[name].agg(F.sum(total)).first()[0] == docs
    assert report["preview_months"].count() == 6
    assert report["preview_rows"].count() == 5
    ratings = [r.nu_rating_review for r in report["count_by_rating"].collect()]
    assert ratings == sorted(ratings, reverse=True)


def test_month_scoped_rebuild_equals_full_rebuild(spark, sf001):
    from revmart.plans.jobs import bronze_job, landing_job, silver_job

    root = scratch_path(spark, "t-incr")
    landing, bronze, silver = (os.path.join(root, z) for z in ("landing", "bronze", "silver"))
    pages = catalog.pages(spark, sf001)
    landing_job(spark, pages, landing)
    bronze_job(spark, landing, bronze)
    silver_job(spark, bronze, silver, dt.datetime(2022, 8, 1))
    june_before = read_zone(spark, silver, SILVER_SCHEMA).where("pt_mes = 6").count()

    # July's landing month is replaced by a re-crawl holding each July review twice
    july = read_landing(spark, landing).where("mes = 7")
    extra = july.unionAll(july).withColumn("ano", F.col("ano").cast("string")).withColumn(
        "mes", F.lpad(F.col("mes").cast("string"), 2, "0"))
    from revmart.sources.zones import write_zone
    write_zone(extra, landing, ["ano", "mes"], overwrite="dynamic")

    bronze_job(spark, landing, bronze, months=["2022-07"])
    silver_job(spark, bronze, silver, dt.datetime(2022, 9, 1), months=["2022-07"])
    got = read_zone(spark, silver, SILVER_SCHEMA)
    assert got.where("pt_mes = 6").count() == june_before  # June untouched
    assert got.where("pt_mes = 6").where(F.col("ts_gravado_em") != F.lit(dt.datetime(2022, 8, 1))).count() == 0
    assert got.where("pt_mes = 7").where(F.col("ts_gravado_em") != F.lit(dt.datetime(2022, 9, 1))).count() == 0

    full = scratch_path(spark, "t-incr-full")
    bronze_job(spark, landing, full)
    assert got.drop("ts_gravado_em").exceptAll(read_zone(spark, full, BRONZE_SCHEMA)).count() == 0
    assert read_zone(spark, full, BRONZE_SCHEMA).exceptAll(got.drop("ts_gravado_em")).count() == 0


def test_month_scoped_rebuild_refuses_empty_month(spark, sf001):
    import pytest

    from revmart.plans.jobs import bronze_job, landing_job

    root = scratch_path(spark, "t-incr2")
    landing_job(spark, catalog.pages(spark, sf001), os.path.join(root, "landing"))
    with pytest.raises(ValueError, match="2022-09"):
        bronze_job(spark, os.path.join(root, "landing"), os.path.join(root, "bronze"), months=["2022-09"])


def test_rerunning_a_stage_is_idempotent(spark, sf001):
    from revmart.plans.jobs import bronze_job, landing_job

    root = scratch_path(spark, "t-rerun")
    landing, bronze = os.path.join(root, "landing"), os.path.join(root, "bronze")
    landing_job(spark, catalog.pages(spark, sf001), landing)
    first = [tuple(r) for r in bronze_job(spark, landing, bronze).orderBy("nu_id").collect()]
    again = [tuple(r) for r in bronze_job(spark, landing, bronze).orderBy("nu_id").collect()]
    assert first == again and len(first) == spark.read.parquet(f"{sf001}/documents.parquet").count()


def test_malformed_timestamp_flows_through_with_null_keys(spark):
    from revmart.operators.conform import add_partition_keys
    from revmart.plans.jobs import bronze_job, only_months
    from revmart.sources.zones import write_zone

    cols = "id string, title string, content string, contentType string, voteSum string, voteCount string, " \
           "rating string, updated string, version string, author string, link string"
    rows = [("1", "t", "c", None, "0", "1", "5", "2022-06-30T23:30:11-07:00", "1.0", None, None),
            ("2", "t", "c", None, "0", "1", "5", "garbage-text", "1.0", None, None),
            ("3", "t", "c", None, "0", "1", "5", None, "1.0", None, None)]
    root = scratch_path(spark, "t-dirty")
    landing, bronze = os.path.join(root, "landing"), os.path.join(root, "bronze")
    write_zone(add_partition_keys(spark.createDataFrame(rows, cols)), landing, ["ano", "mes"])
    assert os.path.isdir(os.path.join(landing, "ano=garb"))  # text keys on disk, as written
    got = {r.nu_id: r for r in bronze_job(spark, landing, bronze).collect()}
    assert (got["1"].pt_ano, got["1"].pt_mes, str(got["1"].dt_date)) == (2022, 6, "2022-06-30")
    assert (got["2"].pt_ano, got["2"].pt_mes, got["2"].dt_date) == (None, None, None)
    assert (got["3"].pt_ano, got["3"].pt_mes, got["3"].dt_date) == (None, None, None)
    june = only_months(read_landing(spark, landing), "ano", "mes", ["2022-06"])
    assert "(try_cast(ano" in june._jdf.queryExecution().executedPlan().toString()  # directories pruned
    assert [r.id for r in june.collect()] == ["1"]


def test_permissive_landing_quarantines_malformed_pages(spark, sf001):
    import pytest

    from revmart.plans.jobs import landing_job

    good = catalog.pages(spark, sf001)
    broken = spark.createDataFrame(
        [("https://x/broken?p=1", "<feed xmlns='http://www.w3.org/2005/Atom'><entry><id>1</id></feed>")],
        "page_url string, xml string",
    )
    pages = good.unionByName(broken)
    root = scratch_path(spark, "t-quarantine")
    with pytest.raises(Exception):
        landing_job(spark, pages, os.path.join(root, "strict"))
    landed = landing_job(spark, pages, os.path.join(root, "landing"), mode="PERMISSIVE",
                         quarantine_path=os.path.join(root, "quarantine"))
    docs = spark.read.parquet(f"{sf001}/documents.parquet").count()
    assert landed.count() == docs
    q = spark.read.parquet(os.path.join(root, "quarantine")).collect()
    assert [r.page_url for r in q] == ["https://x/broken?p=1"]
    # all pages good: no quarantine written
    clean_q = os.path.join(root, "quarantine-clean")
    landing_job(spark, good, os.path.join(root, "landing2"), mode="PERMISSIVE", quarantine_path=clean_q)
    assert not os.path.exists(clean_q)


def test_stream_refuses_permissive_mode(spark):
    import pytest

    with pytest.raises(ValueError):
        start_landing_stream(spark, "/nonexistent", "/nonexistent-out", "/nonexistent-ckpt", mode="PERMISSIVE")


def test_permissive_landing_requires_quarantine(spark, sf001):
    import pytest

    from revmart.plans.jobs import landing_job

    with pytest.raises(ValueError, match="quarantine"):
        landing_job(spark, catalog.pages(spark, sf001), scratch_path(spark, "t-noq"), mode="PERMISSIVE")


def _empty_pages(spark):
    return spark.createDataFrame([], "page_url string, xml string")


@pytest.mark.parametrize("files", ["rebalance", "keep", "compact", 1])
def test_stages_over_zero_rows(spark, sf001, files, tmp_path):
    from revmart.plans.jobs import bronze_job, gold_job, landing_job, silver_job

    # empty only when the query runs: the optimizer cannot see it
    catalog.pages(spark, sf001).write.parquet(str(tmp_path / "pages"))
    pages = spark.read.parquet(str(tmp_path / "pages")).where("length(xml) < 0")
    z = {n: str(tmp_path / n) for n in ("landing", "bronze", "silver", "gold")}
    assert landing_job(spark, pages, z["landing"], files=files).count() == 0
    assert bronze_job(spark, z["landing"], z["bronze"], files=files).count() == 0
    assert silver_job(spark, z["bronze"], z["silver"], files=files).count() == 0
    assert gold_job(spark, z["silver"], z["gold"], view="vw_zero", files=files).count() == 0
    assert landing_job(spark, _empty_pages(spark), z["landing"], files=files).count() == 0


def test_compaction_through_the_jobs(spark, sf001):
    from revmart.plans.jobs import bronze_job, gold_job, landing_job, silver_job

    root = scratch_path(spark, "t-compact")
    z = {n: os.path.join(root, n) for n in ("landing", "bronze", "silver", "gold")}
    landing_job(spark, catalog.pages(spark, sf001), z["landing"])
    bronze_job(spark, z["landing"], z["bronze"])
    silver_job(spark, z["bronze"], z["silver"], files="compact")
    gold_job(spark, z["silver"], z["gold"], view="vw_compact", files="compact")
    for zone, depth in (("silver", "*/*"), ("gold", "*")):
        found = glob.glob(f"{z[zone]}/{depth}/*.parquet")
        assert len(found) == len(glob.glob(f"{z[zone]}/{depth}/")) == len({os.path.dirname(f) for f in found}) > 1


def test_bronze_moves_whole_texts_once(spark, sf001):
    from revmart.sources.zones import layout_for_write

    bronze = catalog.rv_bronze(spark, sf001)
    plan = layout_for_write(bronze, ["pt_ano", "pt_mes"], ["dt_date"], files="keep")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


ODD = [("2022-06-30T23:30:11-07:00",), ("2022-6-30T23:30:11-07:00",), (" 2022-06-30T23:30:11-07:00",)]


def _odd_landing(spark, path):
    from revmart.operators.conform import add_partition_keys
    from revmart.schemas import LANDING_COLUMNS
    from revmart.sources.zones import write_zone

    rows = spark.createDataFrame([(str(i), t) for i, (t,) in enumerate(ODD)], "id string, updated string")
    full = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in LANDING_COLUMNS])
    write_zone(add_partition_keys(full), path, ["ano", "mes"])


def test_partition_form_of_the_month_filter_keeps_odd_keys(spark):
    from revmart.functions.dates import month_filter
    from revmart.plans.jobs import bronze_job

    root = scratch_path(spark, "t-odd")
    _odd_landing(spark, os.path.join(root, "landing"))
    zone = bronze_job(spark, os.path.join(root, "landing"), os.path.join(root, "bronze"))
    assert zone.where("dt_date = DATE'2022-06-30'").count() == 3
    filtered = month_filter(zone, "dt_date", "2022-06", ("pt_ano", "pt_mes"))
    assert filtered.count() == month_filter(zone, "dt_date", "2022-06").count() == 3
    assert "PartitionFilters: [(((" in filtered._jdf.queryExecution().executedPlan().toString()


def test_month_rebuild_takes_rows_with_odd_keys_along(spark):
    from revmart.plans.jobs import bronze_job, silver_job

    root = scratch_path(spark, "t-odd-rebuild")
    landing, bronze, silver = (os.path.join(root, n) for n in ("landing", "bronze", "silver"))
    _odd_landing(spark, landing)
    bronze_job(spark, landing, bronze)
    silver_job(spark, bronze, silver, dt.datetime(2022, 8, 1))
    bronze_job(spark, landing, bronze, months=["2022-06"])
    again = silver_job(spark, bronze, silver, dt.datetime(2022, 9, 1), months=["2022-06"])
    assert [(r.ts_gravado_em, r["count"]) for r in again.groupBy("ts_gravado_em").count().collect()] == [(dt.datetime(2022, 9, 1), 3)]


def test_month_sample_prunes_directories(spark, sf001):
    from revmart.plans.sql import PREVIEW_MONTHS_SQL

    paths = run_stages(spark, catalog.pages(spark, sf001), scratch_path(spark, "t-prune"))
    sample = run_on(spark, PREVIEW_MONTHS_SQL, read_zone(spark, paths["silver"], SILVER_SCHEMA))
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [((((") == 2 and "PartitionFilters: []" not in plan
    assert sample.count() == 6


def test_report_holds_every_check(spark, sf001):
    from revmart.plans.jobs import REPORT_KEYS, quality_report, report_table

    paths = run_stages(spark, catalog.pages(spark, sf001), scratch_path(spark, "t-report"))
    report = quality_report(spark, paths["silver"], landing_path=paths["landing"])
    assert set(report) == set(REPORT_KEYS)
    docs = spark.read.parquet(f"{sf001}/documents.parquet").count()
    totals = {r["check"]: r.n for r in report_table(report).groupBy("check").agg(F.sum("value").alias("n")).collect()}
    assert totals["count_by_year_month"] == totals["count_by_votes"] == docs
    assert [tuple(r) for r in report["null_columns"].collect()] == [(None, None, None)]


def test_sort_key_is_repeatable(spark):
    from revmart.operators.quality import sort_multi_key

    plan = sort_multi_key(spark.range(10).selectExpr("id % 2 AS k", "id"), ["k"])._jdf.queryExecution().analyzed().toString()
    assert "monotonically_increasing_id" not in plan and "xxhash64" in plan


def test_scratch_is_removed_by_its_owner(spark, tmp_path):
    from revmart.session import SCRATCH_CONF, remove_scratch

    spark.conf.set(SCRATCH_CONF, str(tmp_path / "own"))
    try:
        path = scratch_path(spark, "z")
        spark.range(3).write.parquet(path)
        assert path.startswith(str(tmp_path)) and os.path.isdir(path)
        remove_scratch(spark)
        assert not os.path.exists(path)
    finally:
        spark.conf.unset(SCRATCH_CONF)


def test_quarantine_is_this_runs_own(spark, sf001):
    from revmart.plans.jobs import landing_job

    root = scratch_path(spark, "t-quarantine-again")
    landing, quarantine = os.path.join(root, "landing"), os.path.join(root, "quarantine")
    good = catalog.pages(spark, sf001)
    bad = spark.createDataFrame([("u", "<feed><entry><id>1</entry></feed>")], "page_url string, xml string")
    landing_job(spark, good.unionByName(bad), landing, mode="PERMISSIVE", quarantine_path=quarantine)
    assert [r.page_url for r in spark.read.parquet(quarantine).collect()] == ["u"]
    landing_job(spark, good, landing, mode="PERMISSIVE", quarantine_path=quarantine)
    assert spark.read.parquet(quarantine).count() == 0


def test_xml_files_land_with_layout_and_quarantine(spark, sf001, tmp_path):
    import pytest

    from revmart.plans.jobs import landing_job_from_xml_files

    root = scratch_path(spark, "t-xml-quarantine")
    landing, quarantine = os.path.join(root, "landing"), os.path.join(root, "quarantine")
    for i, r in enumerate(catalog.pages(spark, sf001).limit(2).collect()):
        (tmp_path / f"p{i}.xml").write_text(r.xml, encoding="utf-8")
    (tmp_path / "bad.xml").write_text("<feed>\n<entry><id>6</id></entry>\n<entry><id>7</id><title>x</entry><entry><id>8</id></entry></feed>", encoding="utf-8")
    with pytest.raises(ValueError, match="quarantine"):
        landing_job_from_xml_files(spark, str(tmp_path), landing, mode="PERMISSIVE")
    landed = landing_job_from_xml_files(spark, str(tmp_path), landing, mode="PERMISSIVE", files="compact", quarantine_path=quarantine)
    assert landed.count() == 101  # two pages of 50 entries, and the good one before the malformed one
    assert {len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{landing}/*/*")} == {1}
    held = spark.read.parquet(quarantine).collect()
    assert len(held) == 1 and held[0].page_url.endswith("bad.xml") and "<id>8</id>" in held[0].xml
    (tmp_path / "bad.xml").unlink()
    landing_job_from_xml_files(spark, str(tmp_path), landing, mode="PERMISSIVE", quarantine_path=quarantine)
    assert spark.read.parquet(quarantine).count() == 0


def test_counts_and_previews_read_a_written_zone(spark, sf001):
    for name in ("count_by_votes", "count_by_rating_sql", "count_by_version", "preview_months", "preview_rows", "silver_stamp"):
        plan = catalog.QUERIES[name](spark, sf001)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "shared-" in plan, name
