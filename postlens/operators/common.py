"""Shared shapes: top rows per community, one summary row joined to its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(df: DataFrame, n: int | None, order: Sequence[Column], by: Sequence[str] = (), rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per community in the given order, numbered from 1; without ``n`` all of them.

    Over all rows this is a distributed top-k; the numbering then sees n rows.
    Per community Spark cuts each partition to n rows before the shuffle.
    """
    if by:
        ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        return ranked if n is None else ranked.where(F.col(rank) <= n)
    numbered = df if n is None else df.orderBy(*order).limit(n)
    return numbered.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def attach(df: DataFrame, summary: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add the summary's columns to every row of its community.

    Over all rows the summary is one row and is read as a scalar subquery;
    per community it is an equi-join that Spark plans by size.
    """
    if by:
        keys = [F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")) for c in by]
        condition = keys[0]
        for key in keys[1:]:
            condition = condition & key
        added = [F.col(f"_r.{c}") for c in summary.columns if c not in by]
        return df.alias("_l").join(summary.alias("_r"), condition, "left").select("_l.*", *added)
    row = summary.select(F.struct("*")).scalar()
    return df.withColumn("_summary", row).select(*df.columns, *[F.col("_summary")[c].alias(c) for c in summary.columns])


def side_by_side(frames: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """Frames of one row per community as one such frame with all their columns.

    The rows are stacked and folded per community, one small shuffle and no
    join; a column a frame does not have for a community stays NULL.
    """
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    values = [c for c in stacked.columns if c not in by]
    return stacked.groupBy(*by).agg(*[F.any_value(F.col(c), F.lit(True)).alias(c) for c in values])


def post_place(seq: str = "ingest_seq") -> Column:
    """The part of a place that a post gives, see ``place``; an absent number comes first."""
    number = F.coalesce(F.col(seq).cast("decimal(20,0)"), F.lit("-9223372036854775809").cast("decimal(20,0)"))
    return number * F.lit("10000000000").cast("decimal(11,0)")


def place(post: Column, position: Column) -> Column:
    """Post and position as one number, in the order of a struct of both.

    The least one of a group is found by hashing; for a struct Spark sorts all rows.
    """
    return post + position.cast("decimal(10,0)")


def ratio(condition: Column) -> Column:
    """Share of rows that satisfy the condition."""
    return F.avg(condition.cast("double"))


def engagement(*columns: str) -> Column:
    """Sum of counters, an absent one counting as zero."""
    total = F.coalesce(F.col(columns[0]), F.lit(0))
    for name in columns[1:]:
        total = total + F.coalesce(F.col(name), F.lit(0))
    return total
