"""The bronze lake: append-only Parquet below source / ingestion date, read by column name."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.schemas import BRONZE, BRONZE_PARTITIONS, OBSERVATION

FOLDER = "bronze/weather"
# Columns in which a value of another kind fails the read.
HARD = ("city_id", "lat", "lon")


def with_lineage(rows: DataFrame, source: str, instant: datetime) -> DataFrame:
    """Stamp one batch: its source, one ingestion instant, and the instant's date parts."""
    at = instant.astimezone(UTC)
    return rows.withColumns(
        {
            "source": F.lit(source),
            "ingested_at": F.lit(at.isoformat()),
            "ingestion_year": F.lit(at.year),
            "ingestion_month": F.lit(at.month),
            "ingestion_day": F.lit(at.day),
        }
    )


def write_bronze(
    rows: DataFrame, root: str, source: str, instant: datetime | None = None, files: int | None = None
) -> str | None:
    """Append a batch of observations; an empty batch writes nothing and returns None.

    ``files`` fixes the number of files of a small batch; large ones keep Spark's partitions.
    """
    if rows.isEmpty():
        return None
    at = (instant or datetime.now(UTC)).astimezone(UTC)
    canonical = rows.select(*[F.col(f.name).cast(f.dataType) for f in OBSERVATION.fields])
    stamped = with_lineage(canonical, source, at).withColumns(
        {
            "year": F.lit(f"{at.year}"),
            "month": F.lit(f"{at.month:02d}"),
            "day": F.lit(f"{at.day:02d}"),
        }
    )
    if files:
        stamped = stamped.coalesce(files)
    path = f"{root.rstrip('/')}/{FOLDER}"
    stamped.write.mode("append").partitionBy(*BRONZE_PARTITIONS).parquet(path)
    return path


def stored_schema() -> T.StructType:
    """What our own files and path keys hold; for readers that need a schema up front."""
    fields = [f for f in BRONZE.fields if f.name != "source"]
    return T.StructType(fields + [T.StructField(p, T.StringType()) for p in BRONZE_PARTITIONS])


#: Schemas of files that do not agree are read so many at a time.
THREADS = 16


def _children(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The folders and the Parquet files directly below a path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    shown = [s for s in found if s.getPath().getName()[0] not in "._"]
    names = lambda folders: [s.getPath().toString() for s in shown if s.isDirectory() == folders]
    return sorted(names(True)), sorted(n for n in names(False) if n.endswith(".parquet"))


def _common_schema(spark: SparkSession, base: str, paths: Sequence[str]) -> T.StructType | None:
    """The schema of all files below the paths, from their footers, or None if their types do not agree.

    Spark reads the footers in a job of its own, by the session's file system, and only the last bytes of each file.
    """
    try:
        return spark.read.option("basePath", base).option("mergeSchema", True).parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:  # the second for errors of the job that reads the footers
        found = error.java_exception if isinstance(error, Py4JJavaError) else error
        if found.getCondition() not in ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE"):
            raise
        return None


def _agreeing_files(spark: SparkSession, base: str, files: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files of one folder or batch that do not agree, by their schemas."""
    with ThreadPoolExecutor(THREADS) as pool:
        schemas = list(pool.map(lambda f: _common_schema(spark, base, [f]), files))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for file, schema in zip(files, schemas, strict=True):
        groups.setdefault(schema.json(), (schema, []))[1].append(file)
    return list(groups.values())


def _agreeing(spark: SparkSession, base: str, path: str) -> list[tuple[T.StructType, list[str]]]:
    """What to scan together: the path as a whole if all of its files agree, else the same of what lies below it."""
    schema = _common_schema(spark, base, [path])
    if schema is not None:
        return [(schema, [path])]
    folders, files = _children(spark, path)
    groups = [group for folder in folders for group in _agreeing(spark, base, folder)]
    groups += _agreeing_files(spark, base, files)
    joined: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, paths in groups:
        joined.setdefault(schema.json(), (schema, []))[1].extend(paths)
    return list(joined.values())


def _together(spark: SparkSession, base: str, groups: list, extra: Sequence[str] = ()) -> DataFrame:
    """One scan per group, as one canonical frame."""
    scans = [spark.read.schema(schema).option("basePath", base).parquet(*sorted(paths)) for schema, paths in groups]
    return reduce(DataFrame.unionByName, [_as_canonical(s, extra) for s in scans])


def _as_canonical(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Every canonical column, absent ones as typed NULL, then the path keys.

    Ids and coordinates must be what they should be; the other columns are cast tolerantly.
    """
    have = set(df.columns)

    def column(f: T.StructField):
        if f.name not in have:
            return F.lit(None).cast(f.dataType)
        return F.col(f.name).cast(f.dataType) if f.name in HARD else F.col(f.name).try_cast(f.dataType)

    columns = [column(f).alias(f.name) for f in BRONZE.fields]
    # Spark reads the path keys as numbers; give back their zero padding.
    widths = {"year": 4, "month": 2, "day": 2}
    keys = [F.lpad(F.col(k).cast("string"), w, "0").alias(k) for k, w in widths.items() if k in have]
    return df.select(*columns, *keys, *extra)


def read_files(spark: SparkSession, root: str, paths: list[str], extra: Sequence[str] = ()) -> DataFrame:
    """Some files of the lake as one canonical frame, one scan per distinct schema; ``extra`` names more columns."""
    base = f"{root.rstrip('/')}/{FOLDER}"
    schema = _common_schema(spark, base, paths)
    groups = [(schema, paths)] if schema is not None else _agreeing_files(spark, base, paths)
    return _together(spark, base, groups, extra)


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """The whole lake as one canonical frame, whatever physical types its files have.

    Files of other writers may disagree on types (whole numbers here, decimals there), which one Parquet scan refuses.
    Where they do, the folders below are looked at one by one, down to the files of a folder, and there is one scan
    for each distinct schema. The driver sees folder names, and file names only of folders whose files disagree.
    """
    path = f"{root.rstrip('/')}/{FOLDER}"
    return _together(spark, path, _agreeing(spark, path, path))


def read_bronze_uniform(spark: SparkSession, root: str) -> DataFrame:
    """The lake as written by ``write_bronze``: one scan, no look at the footers."""
    path = f"{root.rstrip('/')}/{FOLDER}"
    return _as_canonical(spark.read.schema(stored_schema()).parquet(path))
