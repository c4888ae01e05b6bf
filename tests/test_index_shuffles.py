"""The sale index and its postings: few shuffles, the same rows."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from martlane import catalog
from martlane.operators import sales
from martlane.plans import search
from martlane.sources import fixtures as fx


@pytest.fixture()
def built(monkeypatch):
    """Derived tables as their plans, name -> DataFrame; nothing is written."""
    plans = {}

    def plan(spark, name, inputs, build, sort_cols=(), params=()):
        plans[name] = build()
        return plans[name]
    monkeypatch.setattr(catalog, "derived_table", plan)
    return plans


def shuffles(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]


def test_lines_are_shuffled_once_for_versions_and_orders(spark, built):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = shuffles(catalog.build_sale_index(spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = [line for line in found if "REPARTITION_BY_COL" in line]
    assert len(wide) == 1                              # whole ids: by order, before both steps
    assert sum("hashpartitioning(id#" in line for line in found) <= 4   # ids that lack a number; users; orders
    assert not any("hashpartitioning(user_id" in line and "sku_name" in line for line in found)


def test_index_of_lines_with_null_and_repeated_keys(spark, monkeypatch, built):
    """Ids that lack a number may be those of several orders: resolved by id, as before."""
    def line(order, no, part, supp, price, day):
        ids = "-".join(str(x) for x in (order, no, part, supp) if x is not None)
        return (ids, None if order is None else str(order), f"part {part}", str(part), price, (day, float(day)), day)
    raw = [line(1, 1, 5, 7, "10.0", 3), line(1, 1, 5, 7, "10.0", 9), line(1, 2, 5, None, "2.0", 4),
           line(None, 1, 2, 5, "3.0", 8), line(2, 1, 5, 7, "1.0", 1), line(None, 2, 5, 7, "4.0", 2)]
    details = spark.createDataFrame(raw, "id string, order_id string, sku_name string, sku_id string, "
                                         "order_price string, version struct<ts: long, price: double>, ts long")
    monkeypatch.setattr(fx, "order_detail_raw", lambda spark, d: details)
    # the old way: by id, then the join, then the users
    joined = sales.sale_join(catalog._orders(spark, SF_SMALL), sales.latest_line(details), None)
    want = sales.enrich_user(sales.sale_detail(joined), catalog._users(spark, SF_SMALL), fx.USER_AS_OF)
    got = catalog.build_sale_index(spark, SF_SMALL)
    names = [c for c in got.columns if c != search.TERMS_COL]
    assert rows(got, *names) == rows(want.select(*names)) and got.count() > 0


def test_postings_are_not_shuffled(spark, monkeypatch):
    index = spark.createDataFrame([("1", "2024-01-01", ["a", "b", "a"]), ("2", "2024-01-02", ["b"])],
                                  f"order_detail_id string, dt string, {search.TERMS_COL} array<string>")
    plans = {}
    monkeypatch.setattr(catalog, "sale_index", lambda spark, d: index)
    monkeypatch.setattr(catalog, "derived_table", lambda spark, name, inputs, build, *a: plans.setdefault(name, build()))
    assert rows(catalog.sale_postings(spark, SF_SMALL)) == [
        ("a", "2024-01-01", "1"), ("b", "2024-01-01", "1"), ("b", "2024-01-02", "2")]
    assert not shuffles(plans["sale_postings"])


def test_enriched_orders_give_the_lines_their_user(spark):
    orders = spark.createDataFrame([("1", "x", "2024-01-01 00:00:00", "u", "2024-01-01", 5)],
                                   "id string, order_status string, create_time string, user_id string, "
                                   "create_date string, ts long")
    lines = spark.createDataFrame([("1-1", "1", "n", "s", "2.0", 5)],
                                  "id string, order_id string, sku_name string, sku_id string, order_price string, ts long")
    users = spark.createDataFrame([("u", "F", "3", "2000-01-01")], "id string, gender string, user_level string, birthday string")
    early = sales.sale_detail(sales.sale_join(sales.enrich_user(orders, users, "2020-01-01"), lines, None))
    late = sales.enrich_user(sales.sale_detail(sales.sale_join(orders, lines, None)), users, "2020-01-01")
    assert rows(early, *late.columns) == rows(late) and early.first().user_gender == "F"
