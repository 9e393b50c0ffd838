"""Getting a session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "membertide", master: str | None = None, **conf: str) -> SparkSession:
    """The current session, or a new one with ``conf``.

    Nothing else is set here, since settings made in code win over those of the cluster. The
    plans rely on adaptive execution, which Spark 4 has on by default, and on no time zone:
    they hold dates and zoneless timestamps only.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
