"""What the operators share: reading tables, bounded Arrow batches, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.session import materialise

#: Rows in an Arrow batch. Whole texts travel in batches, so a worker holds this many texts at once.
BATCH_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; also bounds the batches that go to Python workers in this session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def text_of(column: str = "text"):
    """The text column as string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back: cuts lineage, survives lost executors."""
    return materialise(df, f"llm-{name}")


def spare_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """Names for helper columns that no given column has, whatever the case of its letters."""
    used = {c.lower() for c in taken}
    names = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        names.append(name)
    return names
