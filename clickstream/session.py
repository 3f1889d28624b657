"""Session construction and cluster-shared locations.

Nothing here hard-codes a machine-local folder for cluster use: the checkpoint
folder is read from ``spark.checkpoint.dir`` and only set when it is unset
(tests, local runs).
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query in this package relies on.  UTC keeps formatted times and
# DuckDB comparisons stable; AQE coalesces tiny partitions and splits skewed
# join partitions at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "clickstream", extra: dict | None = None) -> SparkSession:
    """Get or create a session with the package defaults.

    ``master`` is only applied when given (local runs and tests); on a cluster the
    launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session.  Where it is unset, a folder
    below the warehouse is used.  A warehouse on the local disk is
    seen by one machine only, so with more than one (a master other than
    ``local[...]``) it is refused.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        sc = spark.sparkContext
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            path = sc._jvm.org.apache.hadoop.fs.Path(d)
            if path.getFileSystem(sc._jsc.hadoopConfiguration()).getUri().getScheme() == "file":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share; "
                                   f"the warehouse folder {d} is local to each machine")
    spark.sparkContext.setCheckpointDir(d)
    return d


_SCRATCH: list[str] = []


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this process has written; returns how many.

    Results that still read them must have been written or collected first.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def materialize(df, name: str):
    """Write ``df`` as a Parquet table under the shared checkpoint folder and read it back.

    Cuts the lineage (an executor loss re-reads the table instead of recomputing
    the plan), computes the input exactly once (an eager ``checkpoint`` evaluates
    it twice), stores it columnar and compressed, and gives later stages file
    statistics.  Costs a fixed write-and-list overhead on tiny inputs.
    """
    spark = df.sparkSession
    path = scratch_table(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scratch_table(spark: SparkSession, name: str) -> str:
    """Path of a new table below the shared checkpoint folder, one that :func:`drop_scratch` deletes."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    _SCRATCH.append(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for one written table."""
    return os.path.join(checkpoint_dir(spark), name)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``clickstream`` importable in the Python workers, once per application.

    Pandas UDFs reference this package's functions, so executors must import
    it.  Installed clusters already can; otherwise the package is zipped on the
    driver and distributed with ``SparkContext.addPyFile``.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="clickstream-pkg-")
    archive = shutil.make_archive(os.path.join(out, "clickstream"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir=os.path.basename(pkg_dir))
    sc.addPyFile(archive)
    _SHIPPED.add(app)
