"""Daily sales figures and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.clock import on_day


def amount(facts: DataFrame, day: int, measure: str = "total_amount", ts: str = "date") -> DataFrame:
    """Sum of a measure on a ``yyyyMMdd`` day (0 is today); null when the day has no rows."""
    return facts.filter(on_day(ts, day)).agg(F.sum(measure).alias(measure))


def gmv(facts: DataFrame, day: int, measure: str = "order_amount", ts: str = "stt") -> DataFrame:
    return amount(facts, day, measure, ts)


def new_count(facts: DataFrame, day: int, ts: str = "date") -> DataFrame:
    """Number of rows of a day."""
    return facts.filter(on_day(ts, day)).agg(F.count("*").alias("new_count"))


def top_by(
    facts: DataFrame,
    day: int,
    keys: Sequence[str],
    measures: Sequence[str],
    limit: int,
    ts: str = "date",
) -> DataFrame:
    """Largest groups of a day by the first measure, positive ones only; ties go by key."""
    first = measures[0]
    return (
        facts.filter(on_day(ts, day))
        .groupBy(*keys)
        .agg(*[F.sum(m).alias(m) for m in measures])
        .filter(F.col(first) > 0)
        .orderBy(F.desc(first), *[F.asc(k) for k in keys])
        .limit(limit)
    )


def top_brands(facts: DataFrame, day: int, limit: int = 10, ts: str = "date") -> DataFrame:
    return top_by(facts, day, ["tm"], ["total_amount", "pro_cnt"], limit, ts)


def top_products(facts: DataFrame, day: int, limit: int = 10) -> DataFrame:
    return top_by(facts, day, ["spu_id", "spu_name"], ["order_amount", "order_ct"], limit, "stt")


def top_categories(facts: DataFrame, day: int, limit: int = 4) -> DataFrame:
    return top_by(facts, day, ["category3_id", "category3_name"], ["order_amount"], limit, "stt")


def top_trademarks(facts: DataFrame, day: int, limit: int = 20) -> DataFrame:
    return top_by(facts, day, ["tm_id", "tm_name"], ["order_amount"], limit, "stt")
