"""Session defaults and the shared work folder.

The library never creates a session inside an operator and changes no setting of a given one; its results do not depend on
the session's zone. ``build_session`` is for tests, the bench and ``spark-submit`` entry points.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What a new session gets unless it is already set.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "refnet", **conf: str) -> SparkSession:
    """A session with the defaults; ``conf`` adds or overrides (dots spelled as ``__``). A running session is returned as
    it is."""
    running = SparkSession.getActiveSession()
    if running is not None:
        return running
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, the folder that the driver and all executors share.

    Only a single-JVM ``local[...]`` session (tests, the bench) may leave it unset and gets a temp folder, since there one
    machine is the whole cluster. Anywhere else a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="refnet-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/refnet/{name}-{uuid.uuid4().hex}"
