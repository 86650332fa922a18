"""Raw edition files: strict text, every column a string.

Quoted answers may hold line breaks, so a file is read by one task. An edition scales by being
a folder of many files; the conformed table is stored as Parquet and read from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The format of the raw files.
RAW_FORMAT = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


class UncheckedHeader(ValueError):
    """The files of a folder repeat a column name, so their headers cannot be compared by name."""


class WidthMismatch(ValueError):
    """An edition's header has another number of columns than expected."""


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Any row that is shorter or longer than the header fails the read.

    So does any file of a folder whose header is not that of the first, in the same order. A header that repeats a name is
    taken from a single file only: Spark renames its columns and compares nothing.
    """
    strict = {**RAW_FORMAT, "inferSchema": "false", "mode": "FAILFAST"}
    header = spark.read.options(**{**strict, "header": "false"}).csv(path).first()
    names = [str(name).lower() for name in header or ()]
    repeated = len(set(names)) < len(names)
    frame = spark.read.options(**strict, enforceSchema=str(repeated).lower()).csv(path)
    if repeated and len(frame.inputFiles()) > 1:
        raise UncheckedHeader(path)
    return frame


def check_width(frame: DataFrame, year: int, expected: int | None) -> DataFrame:
    found = len(frame.columns)
    if expected is not None and found != expected:
        raise WidthMismatch(f"Edition {year}: {found} columns, expected {expected}")
    return frame
