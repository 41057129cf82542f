"""Checkpoints and numbers of equal rows."""

import os
from urllib.parse import urlparse

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest_llm import prose
from revmart.llm.common import BATCH_BYTES, checkpointed, numbered_copies, written
from revmart.llm.neardup import near_duplicates
from revmart.session import remove_scratch, scratch_path


def files_under(folder):
    return sum(len(names) for _, _, names in os.walk(urlparse(folder).path))


def test_checkpoints_go_with_their_owner(spark, make_docs):
    folder = spark.sparkContext.getCheckpointDir()
    remove_scratch(spark)
    before = files_under(folder)
    docs = make_docs([(i, prose(i % 3, 40)) for i in range(12)])
    assert near_duplicates(docs).where("kept").count() == 3
    assert files_under(folder) > before
    remove_scratch(spark)
    assert files_under(folder) == before


def test_checkpoints_leave_no_setting_behind(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    made = checkpointed(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    assert made.count() == 7 and made.join(made, "k").count() == 7 and spark.conf.get(key) == before


def test_copies_are_numbered(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.lit("x").alias("text")).repartition(7)
    found = numbered_copies(rows, ["k"], "n").collect()
    for k in range(3):
        assert sorted(r.n for r in found if r.k == k) == list(range(334 if k == 0 else 333))


@pytest.mark.parametrize(("own", "bound"), [("64MB", BATCH_BYTES), ("1m", 1 << 20), (str(1 << 18), 1 << 18)])
def test_phases_bound_the_bytes_of_their_batches(spark, own, bound):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    texts = spark.range(0, 2400, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))  # 24 MB in one task
    keys = {"spark.sql.execution.arrow.maxBytesPerBatch": own, "spark.sql.execution.arrow.maxRecordsPerBatch": "10000"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        counted = texts.mapInArrow(sizes, "rows long, bytes long")
        for made in (checkpointed(counted), written(counted, scratch_path(spark, "batches"))):
            found = made.agg(F.sum("rows").alias("rows"), F.max("bytes").alias("bytes")).first()
            assert found.rows == 2400 and found.bytes <= bound + 20_000  # the bound and a row
        assert {k: spark.conf.get(k) for k in keys} == keys
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
