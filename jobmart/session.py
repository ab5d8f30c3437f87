"""SparkSession helpers.

The library never builds a session behind the user's back: every operator takes
DataFrames and returns DataFrames.  ``get_session`` exists for tests, the bench and
the command-line entry points; on a cluster the caller's session is used as is.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a local run needs; on a cluster the submitter's values win because
# ``getOrCreate`` returns the existing session unchanged.
_LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "jobmart") -> SparkSession:
    """Return the active session or start a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    for key, value in _LOCAL_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions",
                             str(shuffle_partitions or int(cpus)))
    builder = builder.config("spark.driver.memory", os.environ.get("JOBMART_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir``, else the folder set on the
    context.  Only a local master (tests) gets a scratch folder of its own; on a
    cluster executors would not see it, so its absence is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        # the context keeps a folder of its own below the one that was set
        spark.conf.set("spark.checkpoint.dir", current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="jobmart-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


_STAGED: dict[str, list[str]] = {}      # application -> folders that it staged and still has


def stage(df, name: str = "stage"):
    """Write ``df`` as Parquet under the shared checkpoint folder; (frame that reads it, path).

    Cuts the lineage with one computation (``DataFrame.checkpoint`` would run the
    plan twice unless cached, and stores serialized rows); a lost executor then
    re-reads files instead of recomputing the upstream plan."""
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/jobmart-{name}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df, name: str = "stage"):
    """``stage`` for frames whose files live until ``release``."""
    return stage(df, name)[0]


def drop_staged(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that ``stage`` wrote, once nothing reads them any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    held = _STAGED.get(spark.sparkContext.applicationId, [])
    held[:] = [p for p in held if p not in set(paths)]


def release(spark: SparkSession) -> int:
    """Delete every folder that this application staged and still has, once its results are written; their number."""
    paths = list(_STAGED.get(spark.sparkContext.applicationId, []))
    drop_staged(spark, paths)
    return len(paths)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``jobmart`` importable in the Python workers (the HTML parsers and
    the ``urljoin`` helper run there): zip the package once and add it with
    ``addPyFile``, once per SparkContext.  On a cluster, ``--py-files`` at submit
    time does the same."""
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="jobmart-pyfiles-"), "jobmart.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)
