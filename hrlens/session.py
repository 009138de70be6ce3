"""Spark session settings shared by every job in the package.

The library never creates a cluster session on its own behalf: callers pass
their session in.  ``get_session`` exists for tests, the bench and the CLI.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Confs the semantics depend on plus the
# adaptive-execution switches the join and skew strategy relies on.
REQUIRED_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.javaCharsets": "true",  # cp949 / MS949 CSV scan (D1)
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "hrlens", extra_confs: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package's required settings."""
    master = master or os.environ.get("HRLENS_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app_name)
    for k, v in REQUIRED_CONFS.items():
        b = b.config(k, v)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.driver.memory", os.environ.get("HRLENS_DRIVER_MEM", "16g"))
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    for k, v in (extra_confs or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (local tests) a scratch folder is created and registered.  On a cluster an
    unset folder is an error: executors could not see a machine's own folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="hrlens-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core conf not settable at runtime: the context setting below suffices
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``hrlens`` importable in every Python worker (what ``--py-files`` does).

    UDFs and ``mapInPandas`` functions refer to hrlens modules, so executors
    must import the package.  Once per Spark application the package is zipped
    on the driver and registered with ``addPyFile``; Spark copies it to each
    executor.  Harmless where hrlens is installed on the workers already.
    """
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="hrlens-pyfiles-"), "hrlens.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)


def apply_required_confs(spark: SparkSession) -> None:
    """Set the semantic confs on a session someone else built (runtime-settable only)."""
    ship_package(spark)
    for k, v in REQUIRED_CONFS.items():
        try:
            if spark.conf.get(k, None) != v:
                spark.conf.set(k, v)
        except Exception:  # static conf on a running session: leave as configured
            pass
