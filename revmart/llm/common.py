"""Helpers that several operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revmart.session import checkpoint_root, own_scratch

#: A word is a run of characters outside blank and the five control blanks.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting that ends a query's shuffle files with the query.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's bound on the bytes of a batch on its way to Python.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: A task holds a batch several times (its vectors while they grow, the stream,
#: the worker's copy and the one before), and an executor runs a task a core.
BATCH_BYTES = 4 << 20


@contextmanager
def _phase(spark: SparkSession) -> Iterator[None]:
    """Settings of a phase that is materialised: its shuffle files end with it,
    and its Arrow batches hold ``BATCH_BYTES`` (or one longer row) at most. A
    session's own smaller bound stays."""
    own = spark.conf.get(_BATCH)
    before = {_CLEANUP: spark.conf.get(_CLEANUP, "false"), _BATCH: own}
    spark.conf.set(_CLEANUP, "true")
    spark.conf.set(_BATCH, str(_smaller_batch(own)))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _smaller_batch(own: str) -> int:
    """The smaller one of a session's bound (``64MB``, ``1048576``; -1: none) and ``BATCH_BYTES``."""
    number, unit = re.fullmatch(r"\s*(-?[0-9]+)\s*([a-z]*)\s*", own.lower()).groups()
    size = int(number) << {"k": 10, "m": 20, "g": 30, "t": 40, "p": 50}.get(unit[:1], 0)
    return min(size, BATCH_BYTES) if size > 0 else BATCH_BYTES


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by a reliable checkpoint in the folder that
    the cluster shares (``spark.checkpoint.dir``).

    The shuffle files behind it go once it is written, so a job of several
    phases holds the disk of one. The checkpoint's own files stay until their
    owner calls ``remove_scratch``."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_root(spark))
    with _phase(spark):
        made = df.checkpoint(eager=True)
    own_scratch(spark, made._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())
    return made


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` cut from its lineage by a Parquet table at ``path``, a folder under
    ``scratch_path``: compressed columns, so less disk than ``checkpointed``
    takes for many narrow rows, and phases that are over can be dropped."""
    spark = df.sparkSession
    with _phase(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed_table(df: DataFrame) -> DataFrame:
    """An aggregate that is to be joined back by its own key, materialised.

    Joined straight from the aggregate, the other side would have to meet it
    in the aggregate's partitions. From a table of its own, both sides get a
    shuffle that AQE can cut where one key holds many rows.
    """
    return checkpointed(df)


def numbered_copies(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` with the column ``name``: each row's number, from 0, among
    those with the same non-NULL ``keys``, however many there are.

    For rows that are interchangeable (copies): which of them gets which
    number is left open. A checkpoint fixes the rows' partitions; numbers
    follow from the copies in each partition and a sum over the partitions
    before it, so no task meets more copies than a partition holds.
    """
    fixed = checkpointed(rows.withColumn("__part", F.spark_partition_id()))
    counts = fixed.groupBy("__part", *keys).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*keys).orderBy("__part")) - F.col("__n")
    offsets = counts.select("__part", *keys, before.alias("__before"))
    here = F.row_number().over(Window.partitionBy("__part", *keys).orderBy(F.lit(0)))
    numbered = fixed.withColumn("__here", here).join(offsets, ["__part", *keys])
    return numbered.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("__before") + F.col("__here") - 1).cast("long").alias(name))


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes of a text as a long; 0 for NULL."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def buckets_for(rows: int, rows_per_bucket: int) -> int:
    """How many buckets keep each at about ``rows_per_bucket`` rows."""
    return max(1, -(-rows // rows_per_bucket))


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
