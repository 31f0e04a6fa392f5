from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

from millrace.operators import kpi
from millrace.plans import reports

DAY = 20240102
TS = dt.datetime(2024, 1, 2, 12)
OTHER = dt.datetime(2024, 1, 3)


def facts(spark):
    rows = [("A", 5, 1, TS), ("A", 7, 2, TS), ("B", 3, 1, TS), ("C", -1, 1, TS), ("A", 100, 9, OTHER)]
    return spark.createDataFrame(rows, "tm string, total_amount long, pro_cnt long, date timestamp")


def stats(spark):
    rows = [(1, "p", 10, "c", 100, "t", Decimal("2.50"), 3, TS), (2, "q", 10, "c", 101, "u", Decimal("2.50"), 1, TS)]
    return spark.createDataFrame(
        rows,
        "spu_id int, spu_name string, category3_id int, category3_name string, tm_id int, tm_name string,"
        " order_amount decimal(18,2), order_ct long, stt timestamp",
    )


def test_ranking_fixture(spark):
    assert [tuple(r) for r in kpi.top_brands(facts(spark), DAY, 2).collect()] == [("A", 12, 3), ("B", 3, 1)]
    assert [r.tm for r in kpi.top_brands(facts(spark), DAY).collect()] == ["A", "B"]


def test_figures(spark):
    assert kpi.amount(facts(spark), DAY).first()[0] == 14
    assert kpi.new_count(facts(spark), DAY).first()[0] == 4
    assert kpi.amount(facts(spark), 20200101).first()[0] is None
    assert kpi.new_count(facts(spark), 20200101).first()[0] == 0
    assert kpi.gmv(stats(spark), DAY).first()[0] == Decimal("5.00")


def test_other_rankings_break_ties_by_key(spark):
    assert [tuple(r) for r in kpi.top_products(stats(spark), DAY, 1).collect()] == [(1, "p", Decimal("2.50"), 3)]
    assert [tuple(r) for r in kpi.top_categories(stats(spark), DAY).collect()] == [(10, "c", Decimal("5.00"))]
    assert [r.tm_name for r in kpi.top_trademarks(stats(spark), DAY).collect()] == ["t", "u"]


def one(df):
    return json.loads(df.first().json)


def test_reports(spark):
    f, s = facts(spark), stats(spark)
    assert one(reports.scalar_report(kpi.amount(f, DAY))) == {"status": 0, "data": 14}
    assert reports.scalar_report(kpi.amount(f, 20200101)).first().json == '{"status":0,"data":null}'
    brands = reports.table_report(kpi.top_brands(f, DAY), reports.BRAND_COLUMNS, "total_amount", ["tm"])
    assert one(brands) == {
        "status": 0,
        "data": {
            "columns": [
                {"name": "商品名称", "id": "tm"},
                {"name": "品牌交易额", "id": "total_amount"},
                {"name": "订单数", "id": "pro_cnt"},
            ],
            "rows": [
                {"tm": "A", "total_amount": 12, "pro_cnt": 3},
                {"tm": "B", "total_amount": 3, "pro_cnt": 1},
            ],
        },
    }
    empty = kpi.top_brands(f, 20200101)
    assert one(reports.table_report(empty, reports.BRAND_COLUMNS, "total_amount", ["tm"]))["data"]["rows"] == []
    pairs = reports.name_value_report(
        kpi.top_categories(s, DAY), "category3_name", "order_amount", ["category3_id", "category3_name"]
    )
    assert one(pairs) == {"status": 0, "data": [{"name": "c", "value": 5.0}]}
    series = reports.series_report(kpi.top_trademarks(s, DAY), "tm_name", "order_amount", ["tm_id", "tm_name"])
    assert one(series)["data"] == {"categories": ["t", "u"], "series": [{"data": [2.5, 2.5]}]}


def test_top_k_plan(spark, plan):
    text = plan(kpi.top_brands(facts(spark), DAY))
    assert "TakeOrderedAndProject" in text and "partial_sum" in text
