"""Session construction and the shared scratch folder.

Intermediate zones written by round-trip queries and tests live under the
folder the cluster names in ``spark.checkpoint.dir``. Only when that is unset
(local runs, tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

# Defaults tuned for the pipeline. A key the cluster already configures
# (spark-defaults, --conf) keeps the cluster's value.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # lets REBALANCE split a hot partition directory over several writers
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # whole review texts can be long: bound Arrow batches by bytes, not rows only
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # zones are read by other engines too: standard parquet timestamps, not INT96
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # bound the size of any single output file in a zone
    "spark.sql.files.maxRecordsPerFile": "5000000",
    # a run replaces the whole zone, as the original does; month-scoped
    # rebuilds pass overwrite="dynamic" per write
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_session(master: str | None = None, app_name: str = "revmart", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the pipeline defaults.

    ``master`` is only applied when given; on a cluster the launcher decides.
    Keyword ``conf`` entries (dots written as ``__``) are applied as given;
    the ``DEFAULT_CONF`` values only fill keys nobody configured. The web UI
    stays off.
    """
    overrides = {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in overrides.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configured = spark.sparkContext.getConf()
    for key, value in DEFAULT_CONF.items():
        if key not in overrides and not configured.contains(key):
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder is invisible to executors on other hosts
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        # local runs and tests only
        root = tempfile.mkdtemp(prefix="revmart-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


#: Names the folder that a run's scratch zones go to; whoever sets it owns it.
SCRATCH_CONF = "spark.revmart.scratch.dir"
_scratch_made: dict[int, list[str]] = {}  # by Spark context
_shared_made: dict[tuple[int, str], str] = {}  # by Spark context and key


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under ``spark.revmart.scratch.dir``, else
    under the shared checkpoint root. Results read from it are lazy, so it
    stays until its owner calls ``remove_scratch``."""
    root = spark.conf.get(SCRATCH_CONF, None) or os.path.join(checkpoint_root(spark), "revmart")
    path = os.path.join(root, f"{name}-{uuid.uuid4().hex}")
    own_scratch(spark, path)
    return path


def own_scratch(spark: SparkSession, path: str) -> None:
    """Have ``remove_scratch`` delete ``path`` as well."""
    _scratch_made.setdefault(id(spark.sparkContext), []).append(path)


def shared_scratch(spark: SparkSession, key: str, write: Callable[[str], object]) -> str:
    """A scratch folder that ``write`` fills at the first call for this Spark
    context and ``key``, and that later calls share."""
    own = (id(spark.sparkContext), key)
    if own not in _shared_made:
        path = scratch_path(spark, "shared")
        write(path)
        _shared_made[own] = path
    return _shared_made[own]


def remove_scratch(spark: SparkSession) -> None:
    """Delete the scratch folders made in this process for this Spark context,
    on whatever file system they are."""
    for own in [k for k in _shared_made if k[0] == id(spark.sparkContext)]:
        del _shared_made[own]
    for made in _scratch_made.pop(id(spark.sparkContext), []):
        drop_scratch(spark, made)


def drop_scratch(spark: SparkSession, made: str) -> None:
    """Delete one scratch folder that no result reads any more, on whatever
    file system it is; an absent one is left at that."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(made)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
