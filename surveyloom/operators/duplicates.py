"""Row counts and excess full-row duplicates, exact for rows of any width.

Two rows are copies when all their fields are equal: NULL equals NULL, NaN equals NaN, 0.0 equals -0.0, and timestamps count to the
microsecond. Narrow rows are grouped as they are. Of wide rows only a fingerprint of 128 bits is grouped first; the
rows themselves are shuffled where their fingerprint occurs more than once, and there the fields decide.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

from surveyloom.functions import quoted

#: Rows up to this size by their types (numbers and times count 8, the rest 20) are not worth a fingerprint of 16 bytes and a second pass.
NARROW_BYTES = 64
#: Repeated fingerprints are looked up in a bitmap of 2 ** FILTER_BITS bits, that is in at most 2 ** (FILTER_BITS - 6) rows whatever
#: their number. A row that only shares its bit is grouped in vain, none is missed.
FILTER_BITS = 23

_FIRST, _SECOND, _CELL, _BITS = "_impressao_1", "_impressao_2", "_celula", "_bits"


def copies(frame: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """One row per distinct row, with its number of copies. Copies are combined before the shuffle."""
    columns = _identity(frame, columns, keys)
    return frame.groupBy(*keys, *[quoted(name) for name in columns]).agg(F.count("*").alias("copies"))


def _identity(frame: DataFrame, columns: Sequence[str] | None, keys: Sequence[str]) -> list[str]:
    return [name for name in columns or frame.columns if name not in keys]


def _is_wide(frame: DataFrame, names: Sequence[str]) -> bool:
    kinds = [field.dataType for field in frame.schema.fields if field.name in set(names)]
    return sum(8 if isinstance(kind, (NumericType, BooleanType, DatetimeType)) else 20 for kind in kinds) > NARROW_BYTES


def fingerprint(names: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row. A NULL leaves a hash as it is, so where the NULLs are is hashed as well."""
    fields = [quoted(name) for name in names]
    missing = [field.isNull() for field in fields]
    return [
        F.xxhash64(*fields, *missing).alias(_FIRST),
        F.xxhash64(F.lit(_SECOND), *reversed(missing), *reversed(fields)).alias(_SECOND),
    ]


def _suspects(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """The rows whose fingerprint occurs more than once, and a few that share a bit with one."""
    cell = F.shiftrightunsigned(_FIRST, 64 - (FILTER_BITS - 6)).alias(_CELL)
    bit = F.expr(f"shiftleft(1L, CAST({_FIRST} & 63 AS INT))")
    bitmap = counted.filter("copies > 1").groupBy(cell).agg(F.bit_or(bit).alias(_BITS))
    met = rows.withColumn(_CELL, cell).join(F.broadcast(bitmap), _CELL)
    return met.filter(F.expr(f"getbit({_BITS}, CAST({_FIRST} & 63 AS INT)) = 1"))


def _marked(frame: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    return frame.select("*", *fingerprint([*keys, *names]))


def _counted(marked: DataFrame, keys: Sequence[str]) -> DataFrame:
    return marked.groupBy(*keys, _FIRST, _SECOND).agg(F.count("*").alias("copies"))


def _measured(frame: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Rows and sums per key. Summed by fingerprint they would make a second shuffle of all fingerprints, as the bitmap needs none."""
    values = frame.select(*keys, *[value.alias(name) for name, value in measures.items()])
    return values.groupBy(*keys).agg(F.count("*").alias("copies"), *[F.sum(name).alias(name) for name in measures])


def duplicate_profile(
    frame: DataFrame,
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = (),
    measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """registros, duplicados_excedentes and the sums of `measures` over all rows: per key, or one row for the whole frame."""
    names, measures = _identity(frame, columns, keys), measures or {}
    totals = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("registros", "duplicados_excedentes", *measures)]
    if not _is_wide(frame, names):
        measured = frame.select(*keys, *[quoted(n) for n in names], *[value.alias(name) for name, value in measures.items()])
        grouped = measured.groupBy(*keys, *[quoted(n) for n in names]).agg(
            F.count("*").alias("copies"), *[F.sum(name).alias(name) for name in measures]
        )
        rows = grouped.select(*keys, F.col("copies").alias("registros"), (F.col("copies") - 1).alias("duplicados_excedentes"), *measures)
        return rows.groupBy(*keys).agg(*totals)
    marked = _marked(frame, keys, names)
    counted = _counted(marked, keys)
    exact = copies(_suspects(marked, counted).select(*keys, *[quoted(n) for n in names]), keys=keys)
    none = F.lit(0).cast("long")
    sized = _measured(frame, keys, measures) if measures else counted
    sizes = sized.select(*keys, F.col("copies").alias("registros"), none.alias("duplicados_excedentes"), *measures)
    excess = exact.select(
        *keys, none.alias("registros"), (F.col("copies") - 1).alias("duplicados_excedentes"), *[none.alias(m) for m in measures]
    )
    return sizes.unionByName(excess).groupBy(*keys).agg(*totals)


def repeated_rows(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The distinct rows that occur more than once, with their number of copies."""
    names = _identity(frame, columns, ())
    rows = frame.select(*[quoted(name) for name in names])
    if _is_wide(frame, names):
        marked = _marked(rows, (), names)
        rows = _suspects(marked, _counted(marked, ())).select(*[quoted(name) for name in names])
    return copies(rows).filter(F.col("copies") > 1)
