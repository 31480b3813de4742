"""Monthly report tables built from the daily products, and table profiles."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.times import days_in_month, month_of
from wattlake.functions.values import strict_group, total
from wattlake.schemas import SOURCE_GROUPS

TIME_COLUMNS = ("datetime_utc", "date_utc")


def full_months(df: DataFrame, date_col: str = "date_utc") -> DataFrame:
    """Rows of the months in which every calendar day occurs, with their ``month``.

    The list of complete months is broadcast: a date type has fewer than 120,000 months, so it
    cannot grow with the data.  It is made from the date column alone, which is read a second
    time: bringing all rows of a month together instead would shuffle the whole table by month.
    """
    dated = df.withColumn("month", month_of(F.col(date_col)))
    complete = (
        dated.groupBy("month")
        .agg(days_seen(F.col(date_col)).alias("seen"))
        .filter(F.bit_count("seen") == days_in_month(F.col("month")))
        .select("month")
    )
    return dated.join(F.broadcast(complete), "month", "left_semi")


def days_seen(date_col: Column) -> Column:
    """Aggregate: the days of a month that occur, as bits, which map tasks combine."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth(date_col)))


def _in_full_months(sums: DataFrame) -> DataFrame:
    """Sums per month and something, with the days ``seen`` by each, of complete months only.

    The sums are few, so this decides without a second pass over what they were made of.
    """
    same_month = Window.partitionBy("month")
    return (
        sums.withColumn("days", F.bit_count(F.bit_or("seen").over(same_month)))
        .filter(F.col("days") == days_in_month(F.col("month")))
        .drop("seen", "days")
    )


def monthly_group_shares(
    daily_mix: DataFrame, groups: Mapping[str, Iterable[str]] = SOURCE_GROUPS
) -> DataFrame:
    """(month, group, share): each source group's percentage of a full month's energy."""
    by_source = daily_mix.groupBy(month_of(F.col("date_utc")).alias("month"), "source").agg(
        total(F.col("energy_mwh")).alias("energy_mwh"), days_seen(F.col("date_utc")).alias("seen")
    )
    monthly = (
        _in_full_months(by_source)
        .withColumn("group", strict_group(F.col("source"), groups))
        .groupBy("month", "group")
        .agg(total(F.col("energy_mwh")).alias("energy_mwh"))
    )
    whole = F.col("whole")
    share = F.when(whole != 0, F.col("energy_mwh") / whole * 100).otherwise(F.lit(float("nan")))
    return monthly.withColumn(
        "whole", F.sum("energy_mwh").over(Window.partitionBy("month"))
    ).select("month", "group", share.alias("share"))


def monthly_mix_share(
    daily_mix: DataFrame, groups: Mapping[str, Iterable[str]] = SOURCE_GROUPS
) -> DataFrame:
    """One row per full month and one column per group; a group without energy has 0."""
    shares = monthly_group_shares(daily_mix, groups)
    return (
        shares.groupBy("month")
        .pivot("group", list(groups))
        .agg(F.first("share"))
        .fillna(0.0, subset=list(groups))
        .orderBy("month")
    )


def stack_positions(shares: DataFrame, order: Sequence[str]) -> DataFrame:
    """Where each group's band starts and its label sits, stacking a month's groups in order.

    A group that ``order`` does not name is an error.
    """
    ranks = F.create_map(*(F.lit(x) for pair in zip(order, range(len(order))) for x in pair))
    rank = F.coalesce(
        ranks[F.col("group")],
        F.raise_error(F.concat(F.lit("group without a place in the stack: "), F.col("group"))).cast("int"),
    )
    below = (
        Window.partitionBy("month")
        .orderBy("rank")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bottom = F.coalesce(F.sum("share").over(below), F.lit(0.0))
    return (
        shares.withColumn("rank", rank)
        .withColumn("bottom", bottom)
        .withColumn("label_at", F.col("bottom") + F.col("share") / 2)
        .drop("rank")
    )


def last_month_labels(
    shares: DataFrame, order: Sequence[str], min_share: float = 4.0
) -> DataFrame:
    """Label positions of the latest month's larger bands.

    ``shares`` has one row per month and group, fewer than 120,000 months by the date type, so
    one task may look for the last month; taking it apart would compute the shares twice.
    """
    everything = Window.partitionBy()
    in_latest = (
        shares.withColumn("latest", F.max("month").over(everything))
        .filter(F.col("month") == F.col("latest"))
        .drop("latest")
    )
    return stack_positions(in_latest, order).filter(F.col("share") >= min_share)


def signed_exchange(exports: DataFrame, imports: DataFrame) -> DataFrame:
    """Daily net export per neighbour: exports positive, imports negative."""

    def side(df: DataFrame, end: str, sign: int) -> DataFrame:
        return df.select(
            "date_utc",
            F.col(f"{end}_zone").alias("neighbour"),
            F.col(f"{end}_zone_name").alias("name"),
            (F.col("net_mwh") * sign).alias("net"),
        )

    return side(exports, "to", 1).unionByName(side(imports, "from", -1))


def monthly_net_exchange(
    exports: DataFrame, imports: DataFrame, ordered: bool = True
) -> DataFrame:
    """Net GWh per full month and neighbour; a day counts when any neighbour has it."""
    signed = signed_exchange(exports, imports)
    sums = signed.groupBy(month_of(F.col("date_utc")).alias("month"), "neighbour", "name").agg(
        (total(F.col("net")) / 1000).alias("net_gwh"), days_seen(F.col("date_utc")).alias("seen")
    )
    monthly = _in_full_months(sums)
    return monthly.orderBy("month", "neighbour") if ordered else monthly


def top_partners(monthly: DataFrame, n: int = 8) -> DataFrame:
    """Neighbours with the largest total exchange in either direction."""
    return (
        monthly.groupBy("neighbour", "name")
        .agg(total(F.abs("net_gwh")).alias("net_gwh"))
        .orderBy(F.desc("net_gwh"), "neighbour", "name")
        .limit(n)
    )


def time_column(df: DataFrame) -> str | None:
    return next((c for c in TIME_COLUMNS if c in df.columns), None)


def profile(df: DataFrame, time_col: str | None = None) -> DataFrame:
    """One row: number of rows and the range of the time column."""
    name = time_col or time_column(df)
    moment = F.col(name) if name else F.lit(None).cast("timestamp")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(moment).alias("first_time"),
        F.max(moment).alias("last_time"),
    )


def column_profile(df: DataFrame, error: float = 0.02) -> DataFrame:
    """A row per column, whatever its type: (position, column, type, row_count, nulls, not_numbers,
    distinct_about, least, greatest), from one aggregate over the table.

    ``distinct_about`` counts different values but null, within ``error`` (relative standard
    deviation of the sketch); ``not_numbers`` counts NaN, null for a type that has none.  The least
    and the greatest value are given as text, NaN being greater than all numbers; types without an
    order or a hash (maps, variants) have nulls there.  Of an empty table all counts are 0.
    """
    facts, rows = [], F.count(F.lit(1))
    for at, field in enumerate(df.schema):
        # by position, as two columns may share a name
        value, kind = F.col(f"_{at}"), field.dataType
        plain = not _holds(kind, (T.MapType, T.VariantType))
        fractional = isinstance(kind, (T.DoubleType, T.FloatType))
        none = F.lit(None)
        facts.append(
            F.struct(
                F.lit(at + 1).alias("position"),
                F.lit(field.name).alias("column"),
                F.lit(kind.simpleString()).alias("type"),
                rows.alias("row_count"),
                (rows - F.count(value)).alias("nulls"),
                (F.count_if(F.isnan(value)) if fractional else none).cast("long").alias("not_numbers"),
                (F.approx_count_distinct(value, error) if plain else none).cast("long").alias("distinct_about"),
                (F.min(value) if plain else none).cast("string").alias("least"),
                (F.max(value) if plain else none).cast("string").alias("greatest"),
            )
        )
    if not facts:
        raise ValueError("a table without columns has no profile")
    return df.toDF(*(f"_{i}" for i in range(len(df.columns)))).agg(
        F.array(*facts).alias("facts")
    ).select(F.inline("facts"))


def _holds(kind: T.DataType, kinds: tuple) -> bool:
    """Whether a type is, or has inside it, one of the given kinds."""
    if isinstance(kind, kinds):
        return True
    if isinstance(kind, T.StructType):
        return any(_holds(field.dataType, kinds) for field in kind)
    return isinstance(kind, T.ArrayType) and _holds(kind.elementType, kinds)


def latest_rows(
    df: DataFrame, n: int = 15, time_col: str | None = None, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The last n rows by time, shown oldest first; without a time column, any n rows."""
    name = time_col or time_column(df)
    if name is None:
        return df.limit(n)
    newest = [F.desc_nulls_last(c) for c in [name, *tie_break]]
    return df.orderBy(*newest).limit(n).orderBy(name, *tie_break)


@dataclass(frozen=True)
class TableProfile:
    rows: int
    columns: dict[str, str]
    profile: list
    first_time: object
    last_time: object
    latest: list


def browse(df: DataFrame, n: int = 15) -> TableProfile:
    """What a person looks at first: size, columns and what is in them, time range, latest rows."""
    summary = profile(df).first()
    return TableProfile(
        rows=summary["row_count"],
        columns={field.name: field.dataType.simpleString() for field in df.schema},
        profile=column_profile(df).collect(),
        first_time=summary["first_time"],
        last_time=summary["last_time"],
        latest=latest_rows(df, n).collect(),
    )
