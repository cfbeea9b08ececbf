"""Station registry: a CSV dimension with required columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from almanac.operators.checks import require_columns
from almanac.schemas import REGISTRY, REGISTRY_REQUIRED


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Known columns get their types, further ones stay text; a missing column raises ValueError."""
    header = spark.read.option("header", True).csv(path)
    require_columns(header, REGISTRY_REQUIRED, "The station registry lacks columns")
    types = {f.name: f for f in REGISTRY.fields}
    schema = T.StructType([types.get(c, T.StructField(c, T.StringType())) for c in header.columns])
    return spark.read.option("header", True).schema(schema).csv(path)
