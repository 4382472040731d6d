"""Session helpers.

The library sets only what its jobs rely on: UTC session time zone, AQE with
skew-join splitting, and size-checked broadcasts - the static planner broadcasts
only inputs estimated under 2 MB (estimates of joined tables are unreliable), and
AQE broadcasts a side whose *measured* shuffle size is under 32 MB, sort-merge
joining anything larger. A cluster's own broadcast thresholds are kept. It also
points ``setCheckpointDir`` at the shared ``spark.checkpoint.dir`` and ships the
package to the Python workers.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Fixed settings every job in this package assumes.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Static plans broadcast only inputs whose *estimated* size is tiny (file-size
    # estimates of joined dimensions are products of their inputs, so they are not
    # trusted for more); AQE broadcasts at runtime from the *measured* size of a
    # finished shuffle stage, up to 32 MB, and sort-merge joins anything larger.
    "spark.sql.autoBroadcastJoinThreshold": str(2 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "martlet") -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        configure(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SQL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``martlet`` importable in the Python workers (pandas UDFs reference its
    functions): zip the package once per application and add it with
    ``addPyFile``, the programmatic form of ``--py-files``. The zip is a driver-side
    artifact that Spark serves to the executors; no data goes through it."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import shutil
    from pathlib import Path
    pkg = Path(__file__).resolve().parent
    out = tempfile.mkdtemp(prefix="martlet-pyfiles-")
    stage = os.path.join(out, "src")
    shutil.copytree(pkg, os.path.join(stage, pkg.name),
                    ignore=shutil.ignore_patterns("__pycache__", "*.pyc"))
    zip_path = shutil.make_archive(os.path.join(out, pkg.name), "zip", root_dir=stage)
    sc.addPyFile(zip_path)
    _SHIPPED.add(app)


def configure(spark: SparkSession) -> None:
    """Apply the SQL settings the library relies on to an existing session."""
    for k, v in SQL_CONF.items():
        if k in ("spark.sql.autoBroadcastJoinThreshold",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            # keep a cluster's own broadcast limit when it set one
            if spark.conf.get(k, None) not in (None, "10485760", "10MB", ""):
                continue
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, else the one already set on
    the context. Only a local master, where all tasks share the machine, may go without:
    then a private scratch folder is made; on a cluster that is an error."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        sc.setCheckpointDir(path)
        return path
    given = sc._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get()
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    global _LOCAL_CKPT
    if _LOCAL_CKPT is None:
        _LOCAL_CKPT = tempfile.mkdtemp(prefix="martlet-ckpt-")
        sc.setCheckpointDir(_LOCAL_CKPT)
    return _LOCAL_CKPT


_LOCAL_CKPT: str | None = None


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
