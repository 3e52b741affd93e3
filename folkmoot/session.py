"""Session defaults: UTC, adaptive plans, Arrow transfer."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def builder(app: str = "folkmoot", **options: str) -> SparkSession.Builder:
    """A builder with the defaults; ``options`` use ``__`` for dots and win."""
    out = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in options.items()}}.items():
        out = out.config(key, value)
    return out


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which all executors see.

    A local session that names none (tests) gets a temporary folder; a cluster must name one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="folkmoot-")
        shared = _own[app]
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
