"""Dashboard JSON built from daily figures and rankings; every report is one row ``json``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column headings of the ranking tables.
BRAND_COLUMNS = [("商品名称", "tm"), ("品牌交易额", "total_amount"), ("订单数", "pro_cnt")]
PRODUCT_COLUMNS = [("商品名称", "spu_name"), ("交易额", "order_amount"), ("订单数", "order_ct")]


def _json(data: Column) -> Column:
    body = F.struct(F.lit(0).alias("status"), data.alias("data"))
    return F.to_json(body, {"ignoreNullFields": "false"}).alias("json")


def scalar_report(figure: DataFrame) -> DataFrame:
    """``{status, data: <figure>}`` from a one-row, one-column frame; an empty day gives null."""
    return figure.select(_json(F.col(figure.columns[0])))


def _ranked(ranking: DataFrame, measure: str, keys: Sequence[str]) -> Column:
    """Rows of an already limited ranking as one array, largest first, ties by key."""
    rest = [c for c in ranking.columns if c not in keys]
    order = (-F.col(measure)).alias("_order")
    return F.sort_array(F.collect_list(F.struct(order, *keys, *rest)))


def table_report(
    ranking: DataFrame, columns: Sequence[tuple[str, str]], measure: str, keys: Sequence[str]
) -> DataFrame:
    """``{status, data: {columns: [{name, id}], rows: [{<id>: value}]}}``."""
    heads = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit(i).alias("id")) for name, i in columns]
    )
    rows = F.transform("r", lambda x: F.struct(*[x[i].alias(i) for _, i in columns]))
    ranked = ranking.agg(_ranked(ranking, measure, keys).alias("r"))
    return ranked.select(_json(F.struct(heads.alias("columns"), rows.alias("rows"))))


def name_value_report(
    ranking: DataFrame, name: str, measure: str, keys: Sequence[str]
) -> DataFrame:
    """``{status, data: [{name, value}]}``."""
    ranked = ranking.agg(_ranked(ranking, measure, keys).alias("r"))
    return ranked.select(
        _json(
            F.transform("r", lambda x: F.struct(x[name].alias("name"), x[measure].alias("value")))
        )
    )


def series_report(ranking: DataFrame, name: str, measure: str, keys: Sequence[str]) -> DataFrame:
    """``{status, data: {categories: [...], series: [{data: [...]}]}}``."""
    ranked = ranking.agg(_ranked(ranking, measure, keys).alias("r"))
    series = F.array(F.struct(F.transform("r", lambda x: x[measure]).alias("data")))
    names = F.transform("r", lambda x: x[name])
    return ranked.select(_json(F.struct(names.alias("categories"), series.alias("series"))))
