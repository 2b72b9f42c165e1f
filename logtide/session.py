"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def build_session(
    app_name: str = "logtide", master: str | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` entries win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local-mode session may go without it; it then gets one folder of its
    own per application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="logtide-")
    return _LOCAL_DIRS[app]


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path (not yet created) below the shared folder."""
    return f"{shared_dir(spark)}/logtide/{name}-{uuid.uuid4().hex}"
