"""Declared schemas against those found: missing, extra, widened, narrowed and changed columns."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING, EXTRA, WIDENED, NARROWED, CHANGED = "missing", "extra", "widened", "narrowed", "changed"
# Differences a reader of the declared columns can live with.
HARMLESS = {EXTRA, NARROWED}
# Each type holds every value of those before it.
LADDERS = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()),
    (T.FloatType(), T.DoubleType()),
    (T.ShortType(), T.FloatType()),
    (T.IntegerType(), T.DoubleType()),
    (T.DateType(), T.TimestampNTZType()),
)


class Difference(NamedTuple):
    column: str
    difference: str
    declared: str | None
    found: str | None


class SchemaMismatch(ValueError):
    """A table does not hold what its readers were promised."""


def holds(wide: T.DataType, narrow: T.DataType) -> bool:
    """Whether every value of ``narrow`` is one of ``wide``."""
    if isinstance(wide, T.DecimalType) and isinstance(narrow, T.DecimalType):
        whole = wide.precision - wide.scale >= narrow.precision - narrow.scale
        return whole and wide.scale >= narrow.scale
    return any(narrow in steps and wide in steps[steps.index(narrow) :] for steps in LADDERS)


def schema_differences(declared: str | T.StructType, found: T.StructType) -> list[Difference]:
    """One entry per column that differs, in order of name; names are matched without regard to case.

    ``widened``: the column holds values its declared type cannot; ``narrowed``: it is declared wider than it is.
    """
    wanted = T.StructType.fromDDL(declared) if isinstance(declared, str) else declared
    ours = {f.name.lower(): f.dataType for f in wanted}
    theirs = {f.name.lower(): f.dataType for f in found}
    out = []
    for name in sorted(ours.keys() | theirs.keys()):
        one, other = ours.get(name), theirs.get(name)
        if one == other:
            continue
        if other is None:
            kind = MISSING
        elif one is None:
            kind = EXTRA
        elif holds(other, one):
            kind = WIDENED
        else:
            kind = NARROWED if holds(one, other) else CHANGED
        out.append(Difference(name, kind, one and one.simpleString(), other and other.simpleString()))
    return out


def check_schema(declared: str | T.StructType, found: T.StructType, label: str, harmless: set[str] = HARMLESS) -> list[Difference]:
    """The differences, if all are harmless; an error that names the others, if not."""
    differences = schema_differences(declared, found)
    grave = [d for d in differences if d.difference not in harmless]
    if grave:
        said = "; ".join(f"{d.column}: {d.difference}, declared {d.declared}, found {d.found}" for d in grave)
        raise SchemaMismatch(f"{label}: {said}")
    return differences


def schema_report(table: DataFrame, declared: str | T.StructType) -> DataFrame:
    """(column_name, difference, declared, found, rows_affected): each difference with the rows it touches, in one pass.

    A missing column touches every row, an extra one the rows that have a value, and one of another type those
    whose value the declared type cannot give back unchanged.
    """
    wanted = T.StructType.fromDDL(declared) if isinstance(declared, str) else declared
    types = {f.name.lower(): f.dataType for f in wanted}
    differences = schema_differences(wanted, table.schema)
    counts = []
    for d in differences:
        if d.difference == MISSING:
            touched = F.lit(True)
        else:
            value = F.col(f"`{d.column}`")
            touched = value.isNotNull()
            if d.difference != EXTRA:
                kept = value.try_cast(types[d.column]).try_cast(table.schema[_own_name(table, d.column)].dataType)
                touched = touched & ~value.eqNullSafe(kept)
        counts.append(F.struct(*[F.lit(v).cast("string").alias(c) for c, v in zip(REPORT, d)], F.count_if(touched).alias("rows_affected")))
    if not counts:
        return table.sparkSession.createDataFrame([], ", ".join(f"{c} STRING" for c in REPORT) + ", rows_affected BIGINT")
    return table.agg(F.array(*counts).alias("all")).select(F.inline("all"))


REPORT = ("column_name", "difference", "declared", "found")


def _own_name(table: DataFrame, name: str) -> str:
    return next(c for c in table.columns if c.lower() == name)
