"""The stage CLI, run in-process against the test session."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from revmart.cli import main
from revmart.plans import catalog
from revmart.schemas import GOLD_SCHEMA, SILVER_SCHEMA
from revmart.session import scratch_path
from revmart.sources.zones import read_landing, read_zone


def test_cli_runs_every_stage(spark, sf001, capsys):
    root = scratch_path(spark, "t-cli")
    pages = os.path.join(root, "pages")
    catalog.pages(spark, sf001).write.parquet(pages)
    z = {n: os.path.join(root, n) for n in ("landing", "bronze", "silver", "gold")}
    main(["landing", "--pages", pages, "--out", z["landing"]])
    main(["bronze", "--in", z["landing"], "--out", z["bronze"]])
    main(["silver", "--in", z["bronze"], "--out", z["silver"]])
    main(["silver", "--in", z["bronze"], "--out", z["silver"], "--months", "2022-07"])
    main(["gold", "--in", z["silver"], "--out", z["gold"]])
    docs = spark.read.parquet(f"{sf001}/documents.parquet").count()
    assert read_zone(spark, z["silver"], SILVER_SCHEMA).count() == docs
    assert read_zone(spark, z["gold"], GOLD_SCHEMA).count() > 0
    report = os.path.join(root, "report")
    main(["report", "--in", z["silver"], "--landing", z["landing"], "--out", report])
    out = capsys.readouterr().out
    assert "-- count_by_rating" in out and "-- null_columns" in out
    # results are written whole: no rows or characters cut
    assert spark.read.parquet(os.path.join(report, "count_by_version")).agg(F.sum("total")).first()[0] == docs
    texts = {r.ds_reviews for r in read_zone(spark, z["silver"], SILVER_SCHEMA).collect()}
    assert {r.ds_reviews for r in spark.read.parquet(os.path.join(report, "preview_months")).collect()} <= texts
    with pytest.raises(SystemExit):
        main(["report", "--in", z["silver"]])


def test_cli_compacts(spark, sf001):
    root = scratch_path(spark, "t-cli-files")
    pages, landing, bronze = (os.path.join(root, n) for n in ("pages", "landing", "bronze"))
    catalog.pages(spark, sf001).write.parquet(pages)
    main(["landing", "--pages", pages, "--out", landing])
    main(["bronze", "--in", landing, "--out", bronze, "--files", "compact"])
    assert {len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{bronze}/*/*")} == {1}


def test_cli_landing_from_raw_xml_files(spark, sf001, tmp_path):
    pages = catalog.pages(spark, sf001).limit(2).collect()
    for i, r in enumerate(pages):
        (tmp_path / f"p{i}.xml").write_text(r.xml, encoding="utf-8")
    out = scratch_path(spark, "t-cli-xml")
    main(["landing", "--pages", str(tmp_path), "--pages-format", "xml-entries", "--out", out])
    assert read_landing(spark, out).count() == 100  # two pages of 50 entries


@pytest.mark.parametrize("argv", [
    ["landing", "--pages", "p", "--out", "o", "--months", "2022-07"],
    ["landing", "--pages", "p", "--pages-format", "xml-entries", "--out", "o", "--log-unknown-tags"],
    ["bronze", "--in", "l", "--out", "o", "--quarantine", "q"],
    ["gold", "--in", "s", "--out", "o", "--mode", "PERMISSIVE"],
    ["report", "--in", "s", "--out", "o", "--files", "compact"],
])
def test_cli_refuses_options_that_a_stage_does_not_use(argv, capsys):
    with pytest.raises(SystemExit):
        main(argv)
    assert "does not use" in capsys.readouterr().err
