"""Enforcing a table contract on the rows about to be written."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.schemas import TableContract


class SchemaMismatch(ValueError):
    """The frame's columns are not the table's columns."""


def _parts(kind: T.DataType) -> dict[str, T.DataType]:
    """What a nested type is made of, by the name of the place."""
    if isinstance(kind, T.StructType):
        return {field.name: field.dataType for field in kind}
    if isinstance(kind, T.ArrayType):
        return {"element": kind.elementType}
    if isinstance(kind, T.MapType):
        return {"key": kind.keyType, "value": kind.valueType}
    return {}


def _differences(
    wanted: T.DataType, found: T.DataType, place: str = ""
) -> Iterator[tuple[str, str, str | None, str | None]]:
    """(place, kind of difference, wanted, found) between two types, down into nested ones."""
    if type(wanted) is not type(found) or not _parts(wanted):
        if wanted != found:
            yield place, "type", wanted.simpleString(), found.simpleString()
        return
    ours, theirs = _parts(wanted), _parts(found)
    under = f"{place}." if place else ""
    for name, kind in ours.items():
        if name not in theirs:
            yield under + name, "missing", kind.simpleString(), None
        else:
            yield from _differences(kind, theirs[name], under + name)
    for name, kind in theirs.items():
        if name not in ours:
            yield under + name, "extra", None, kind.simpleString()
    shared = [name for name in theirs if name in ours]
    in_order = [name for name in ours if name in theirs]
    for name, expected in zip(shared, in_order, strict=True):
        if name != expected:
            yield under + name, "order", str(in_order.index(name) + 1), str(shared.index(name) + 1)


def drift(df: DataFrame, schema: T.StructType) -> DataFrame:
    """How a frame departs from a schema, as rows: (place, difference, wanted, found, rows_with_value).

    ``difference`` is missing, extra, type or order (positions among the columns both have); places
    inside structs, arrays and maps are told by their path.  ``rows_with_value`` counts the frame's
    rows in which the top-level column of that place is not null: how much data a repair is about;
    null for a column that is not there.  One pass over those columns; a frame that conforms gives
    no rows and is not read.  Names are compared as written; a frame with two columns of one
    name is refused.
    """
    names = df.columns
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise SchemaMismatch(f"two columns are named {', '.join(twice)}")
    found = list(_differences(schema, df.schema))
    spark = df.sparkSession
    columns = "place string, difference string, wanted string, found string, rows_with_value bigint"
    if not found:
        return spark.createDataFrame([], columns)
    # a name may hold a dot, so the top-level column is the longest one the place begins with
    def top(place: str) -> str | None:
        holds = [name for name in names if place == name or place.startswith(f"{name}.")]
        return max(holds, key=len, default=None)

    tops = sorted({name for place, *_ in found if (name := top(place))})
    counts = [F.count(df[f"`{name.replace('`', '``')}`"]).alias(str(i)) for i, name in enumerate(tops)]
    counted = df.agg(F.array(*counts).alias("counts"))
    rows = [(*row, tops.index(top(row[0])) if top(row[0]) else None) for row in found]
    told = spark.createDataFrame(rows, "place string, difference string, wanted string, found string, at int")
    return told.join(F.broadcast(counted), F.lit(True)).select(
        "place", "difference", "wanted", "found", F.get("counts", F.col("at")).alias("rows_with_value")
    )


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Columns in table order; a missing, extra or differently typed column is refused."""
    wanted = {field.name: field.dataType for field in contract.schema}
    found = {field.name: field.dataType for field in df.schema}
    problems = [
        *(f"missing column {name}" for name in wanted if name not in found),
        *(f"unexpected column {name}" for name in found if name not in wanted),
        *(
            f"column {name} is {found[name].simpleString()}, not {wanted[name].simpleString()}"
            for name in wanted
            if name in found and found[name] != wanted[name]
        ),
    ]
    if problems:
        raise SchemaMismatch(f"{contract.name}: {'; '.join(problems)}")
    return df.select(*contract.schema.names)


def _broken(rule: str) -> Column:
    """A rule holds only when it is true: unknown counts as broken."""
    return ~F.coalesce(F.expr(rule), F.lit(False))


def guard(df: DataFrame, contract: TableContract) -> DataFrame:
    """The same rows; the first row breaking a rule fails the job that writes them.

    The test sits in the written column itself, so checking costs no extra pass, and the
    staged commit of the table writers makes a failed job leave the table as it was.
    """
    failed = F.coalesce(
        *(F.when(_broken(rule), F.lit(name)) for name, rule in contract.rules.items())
    )
    message = F.concat(F.lit(f"{contract.name}: failed validation check "), failed)
    first = contract.schema.names[0]
    checked = F.when(failed.isNull(), F.col(first)).otherwise(F.raise_error(message))
    return df.withColumn(first, checked)


def violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """Rows breaking each rule, counted in one pass: (rule, violations)."""
    counts = [F.count_if(_broken(rule)).alias(name) for name, rule in contract.rules.items()]
    return df.agg(*counts).unpivot([], list(contract.rules), "rule", "violations")
