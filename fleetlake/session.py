"""Session helpers: one place for the settings every job here relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library's semantics depend on (UTC timestamps, AQE for skew and
# join re-planning). Cluster-level sizing is left to the deployment.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, *, shuffle_partitions: int | None = None,
                  app_name: str = "fleetlake", extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with UTC time and AQE on.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset so the deployment's values apply.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _REQUIRED.items():
        b = b.config(k, v)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in _REQUIRED.items():
        spark.conf.set(k, v)
    return spark


_LOCAL_CHECKPOINT_DIRS: dict[int, str] = {}


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared lineage-cut folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return d or _LOCAL_CHECKPOINT_DIRS.get(id(spark.sparkContext._jsc))  # noqa: SLF001 - one entry per live context


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; create a scratch one only when unset.

    On a cluster the deployment sets ``spark.checkpoint.dir`` to shared storage
    and it is used as-is. Only local runs and tests (where it is unset) get a
    fresh folder under the system temp dir, registered for this context with
    ``setCheckpointDir`` (the config itself cannot change at run time). With any
    other master an unset folder is an error: executors do not share local disks.
    """
    d = checkpoint_dir(spark)
    if d is None:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="fleetlake-ckpt-")
        _LOCAL_CHECKPOINT_DIRS[id(spark.sparkContext._jsc)] = d  # noqa: SLF001
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for a written intermediate table."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in executor Python workers (once per context).

    Needed only by the few operators that run Python on executors
    (``mapInPandas``); zips the package and hands it to ``addPyFile``, which
    distributes it to every executor like ``--py-files`` would.
    """
    sc = spark.sparkContext
    key = id(sc._jsc)  # noqa: SLF001 - one entry per live context
    if key in _SHIPPED:
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="fleetlake-pyfiles-")
    archive = shutil.make_archive(os.path.join(out_dir, "fleetlake"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir=os.path.basename(pkg_dir))
    sc.addPyFile(archive)
    _SHIPPED.add(key)


def materialize(df, name: str):
    """Write ``df`` as a parquet table under the shared checkpoint folder and
    read it back: the result is computed once, survives executor loss, and
    cuts the lineage for every later branch that reads it."""
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"materialized/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)
