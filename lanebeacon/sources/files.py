"""File names as data: the day a daily file stands for, and the master file formats."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

INGEST_DATE = "ingest_date"
SOURCE_FILE = "source_file"
FILE_KEY = "file_key"
# The text of a line that does not parse; NULL for all others.
CORRUPT = "_corrupt_record"

# The two shapes of the date in daily file names, rooms-2017-10-08.json and 8-10-2017.json.
YEAR_FIRST = r"(?<!\d)\d{4}-\d{1,2}-\d{1,2}(?=\.)"
DAY_FIRST = r"(?<!\d)\d{1,2}-\d{1,2}-\d{4}(?=\.)"


def file_day(path: Column) -> Column:
    """The date in the name of a daily file, NULL if it has none."""
    name = F.substring_index(path, "/", -1)
    turned = F.array_join(F.reverse(F.split(F.regexp_extract(name, DAY_FIRST, 0), "-")), "-")
    return F.coalesce(F.regexp_extract(name, YEAR_FIRST, 0).try_cast("date"), turned.try_cast("date"))


def file_key(path: Column) -> Column:
    """A file's own partition within its day: its name and a hash of its whole path."""
    return F.concat(F.substring_index(path, "/", -1), F.lit("-"), F.lower(F.hex(F.xxhash64(path))))


def with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema, StructField(CORRUPT, StringType())])


# How daily masters are partitioned.
DATED = StructType([StructField(INGEST_DATE, DateType()), StructField(FILE_KEY, StringType())])


@dataclass(frozen=True)
class DailyFile:
    """A file of a scan: its path as in the file columns, and its partition in a master."""

    path: str
    day: date
    key: str


def scanned_files(raw: DataFrame) -> list[DailyFile]:
    """The files that ``raw`` scans, by the scan's own list: empty ones and those in ``k=v`` folders too.

    Only names are read. A file without a date in its name is an error.
    """
    # The file columns have them without an empty authority.
    names = [re.sub(r"^(\w+):///", r"\1:/", name) for name in raw.inputFiles()]
    path = F.col("path")
    rows = raw.sparkSession.createDataFrame([(name,) for name in names], "path string")
    found = [DailyFile(*row) for row in rows.select(path, file_day(path), file_key(path)).collect()]
    for file in found:
        if file.day is None:
            raise ValueError(f"no date in the name of {file.path}")
    return sorted(found, key=lambda file: file.path)


def with_file_columns(scan: DataFrame) -> DataFrame:
    """Adds ``source_file`` (the full path) and ``ingest_date`` (from the file's name)."""
    path = F.col("_metadata.file_path")
    return scan.withColumns({SOURCE_FILE: path, INGEST_DATE: file_day(path)})


def read_master(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType,
    fmt: str,
    header: bool = False,
    partitions: StructType = StructType(),
) -> DataFrame:
    """Master data as parquet, or as CSV bound to ``schema`` by position.

    A parquet master that has no data file any more has no rows, of ``schema`` and ``partitions``.
    """
    if fmt == "parquet":
        try:
            return spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
        except AnalysisException as nothing:
            if nothing.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return spark.createDataFrame([], StructType([*schema, *partitions]))
    if fmt == "csv":
        return spark.read.schema(schema).csv(paths, header=header, enforceSchema=True)
    raise ValueError(f"fmt must be 'parquet' or 'csv', not {fmt!r}")


def open_bucketed(spark: SparkSession, table: str, path: str, schema: StructType, by: list[str], buckets: int) -> DataFrame:
    """A table of ``write_bucketed``, made known to this session's catalog if it is not yet."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    keys = ", ".join(f"`{name}`" for name in by)
    clustered = f"clustered by ({keys}) sorted by ({keys}) into {buckets} buckets"
    spark.sql(f"create table if not exists {table} ({columns}) using parquet {clustered} location '{path}'")
    return spark.table(table)
