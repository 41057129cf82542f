"""Zone tables: folders of hive-partitioned parquet, addressed by path.

Writes never funnel a zone through one task. The default layout asks AQE to
REBALANCE rows by the partition columns: small directories are packed into
one writer each, while a hot directory (say one month holding a third of all
reviews) is split over several writers instead of landing on one. Each
writer then sorts its rows locally, which gives the in-file order without a
global range sort.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.schemas import LANDING_COLUMNS, LANDING_FILE_SCHEMA, LANDING_PARTITIONS

log = logging.getLogger(__name__)


class ZoneWrite(NamedTuple):
    path: str
    rows: int


def layout_for_write(
    df: DataFrame,
    partition_cols: Sequence[str],
    sort_cols: Sequence[str] = (),
    files: str | int = "rebalance",
    observation: Observation | None = None,
) -> DataFrame:
    """Arrange rows for a partitioned write. [O-11, O-40]

    ``files``:
      * ``"rebalance"`` - AQE-sized writers keyed by the partition columns
        (one shuffle; skew-split; the default for zones built by a shuffle);
      * ``"keep"`` - no shuffle: keep the input partitioning (right when the
        input is already a zone partitioned the same way, e.g. silver from
        bronze: an input split holds one directory, or a few small ones);
      * ``"compact"`` - one writer, so one file, per directory, all
        directories in parallel (right when a directory is small);
      * an int ``n`` - ``coalesce(n)``, the original single-file compaction
        (only sensible for small outputs).
    """
    if files == "rebalance":
        if df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() != "true":
            log.warning("AQE is off: REBALANCE cannot split a hot partition directory over writers")
        arranged = df.hint("rebalance", *partition_cols) if partition_cols else df.hint("rebalance")
    elif files == "keep":
        arranged = df
    elif files == "compact":
        arranged = df.repartition(*partition_cols) if partition_cols else df.repartition(1)
    elif isinstance(files, int):
        arranged = df.coalesce(files)
    else:
        raise ValueError(f"unknown file layout: {files!r}")
    if observation is not None:
        # above the shuffle: AQE replaces an empty input, and would lose a count taken below it
        arranged = arranged.observe(observation, F.count(F.lit(1)).alias("rows"))
    order = [*partition_cols, *sort_cols]
    return arranged.sortWithinPartitions(*order) if order else arranged


def write_zone(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    sort_cols: Sequence[str] = (),
    files: str | int = "rebalance",
    mode: str = "overwrite",
    compression: str = "zstd",
    overwrite: str = "static",
) -> ZoneWrite:
    """Write ``df`` as partitioned parquet at ``path`` (static overwrite). [O-08, O-09, O-10]

    zstd by default: zones carry whole review texts, which it packs tighter
    than snappy, and the bytes read back are what later stages pay for.
    The row count is observed during the write itself (no second pass over
    the lineage to count what was written). ``overwrite="dynamic"`` replaces
    only the partition directories present in ``df`` and keeps the others.
    """
    observation = Observation("zone_write")
    arranged = layout_for_write(df, partition_cols, sort_cols, files, observation)
    writer = arranged.write.mode(mode).option("compression", compression)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", overwrite)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
    rows = int(observation.get["rows"])
    log.info("zone written: %s (%d rows)", path, rows)
    return ZoneWrite(path, rows)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Read the landing zone with int year/month keys. [O-07]

    The keys are read as text and converted with ``try_cast``: a key cut
    from a malformed timestamp (``ano=garb``) becomes NULL instead of failing
    the scan, while well-formed ones (``mes=06``) become ints. Filters on the
    converted keys still prune partition directories.
    """
    raw = spark.read.schema(LANDING_FILE_SCHEMA).parquet(path)
    keys = [F.col(k).try_cast("int").alias(k) for k in LANDING_PARTITIONS]
    return raw.select(*LANDING_COLUMNS, *keys)


def read_zone(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a zone back. [O-07]

    With ``schema`` the partition columns get the declared types instead of
    whatever partition-value inference would pick."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)
