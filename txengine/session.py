"""Spark session settings the engine relies on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job assumes. Timestamps are TIMESTAMP_NTZ throughout, so the time zone
# only matters for casts to instants; UTC keeps those stable.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "txengine",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    event_log_dir: str | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; ``spark.checkpoint.dir``
    must then name a shared folder. Only when it is unset (local runs, tests) do we create
    one under the system temp folder.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        settings.setdefault("spark.driver.memory", "16g")
        # local runs keep catalog tables out of the working directory
        settings.setdefault("spark.sql.warehouse.dir", _own_folder("txengine-wh-"))
    if event_log_dir:
        # stage and task times without the UI: read them back with tests/stage_times.py
        settings["spark.eventLog.enabled"] = "true"
        settings["spark.eventLog.dir"] = event_log_dir
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _own_folder(prefix: str) -> str:
    """A fresh folder of a local run, removed when the process ends."""
    path = tempfile.mkdtemp(prefix=prefix)
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables, models and CSV stages.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint dir). Only
    if neither is set -- local mode and tests -- a fresh folder is created and registered.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = _own_folder("txengine-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared folder (never reused between runs)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
