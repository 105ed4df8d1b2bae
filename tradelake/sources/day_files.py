"""Day files: CSV with a header, one name per day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tradelake.functions.calendar import day_name
from tradelake.schemas import RECORD

# Fixed value: the time format of files and messages from senders that know whole seconds only.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# What is written unless asked otherwise, and what is read: a fraction may be missing.
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_READ_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"

# Quotes inside a cell are doubled, as other CSV tools write and read them.
_OPTIONS = {
    "header": "true",
    "escape": '"',
}


def _times(pattern: str) -> dict[str, str]:
    return {"timestampNTZFormat": pattern, "timestampFormat": pattern}


def day_file(folder: str, day: date) -> str:
    return f"{folder}/{day_name(day)}.csv"


def write_day_file(
    df: DataFrame, folder: str, day: date, time_format: str = MICROS
) -> str:
    """Write a day's records as a folder of CSV parts; missing values become empty cells."""
    path = day_file(folder, day)
    df.write.options(**_OPTIONS, **_times(time_format)).csv(path)
    return path


def read_day_file(
    spark: SparkSession, folder: str, day: date, schema: T.StructType = RECORD
) -> DataFrame:
    """Read a day file by its declared schema: no inference pass, no guessing of types."""
    return spark.read.schema(schema).options(**_OPTIONS, **_times(_READ_FORMAT)).csv(day_file(folder, day))
