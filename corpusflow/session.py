"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every corpusflow job relies on. Shuffle partitions are a starting
# point only: AQE coalesces small partitions and splits skewed ones at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of intermediate results are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, cpus: int | None = None,
                app: str = "corpusflow", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session configured for corpusflow.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests and
    the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master:  # a local session; on a cluster the launcher's setting holds
        conf["spark.sql.shuffle.partitions"] = str(cpus or os.cpu_count() or 8)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``corpusflow`` importable in Python workers (Arrow UDFs,
    ``mapInPandas``, ``applyInPandas`` reference its functions): zip the
    package once per SparkContext and ``addPyFile`` it, the programmatic form
    of ``--py-files``."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="corpusflow-pkg-"), "corpusflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder + package shipping + UTC session time; idempotent."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it; only when it is unset (a laptop, a unit test) do we set
    our own so that ``checkpoint()`` and streaming checkpoints have a home.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="corpusflow-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared checkpoint folder.

    Used for landed files, snapshot tables and streaming checkpoints; never a
    machine-local temp folder, so every executor sees the same files.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/corpusflow-scratch/{name}-{uuid.uuid4().hex[:12]}"
