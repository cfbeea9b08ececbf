"""Spark session settings and the shared working folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "almanac", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC as its time zone; extra settings are passed as given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Observation times are naive UTC; truncation and text formats follow the session zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="almanac-")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach.

    A session whose executors are threads of its own process may go without; it then gets a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/almanac-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back, so that later passes do not recompute."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_once(*jobs: Callable[[], object]) -> list:
    """Run independent jobs side by side, as small ones leave executors idle; the first error of any is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]
