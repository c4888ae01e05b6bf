"""Hand-made edge rows for the scalar functions."""

from pyspark.sql import functions as F

from martlane.functions import scalar as S


def one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"x {typ}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_mask_tel(spark):
    assert one(spark, S.mask_tel, None) is None
    assert one(spark, S.mask_tel, "") == "*******"
    assert one(spark, S.mask_tel, "12") == "12*******"
    assert one(spark, S.mask_tel, "1381") == "1381*******"
    assert one(spark, S.mask_tel, "13812345678") == "1381*******"


def test_create_date_hour(spark):
    assert one(spark, S.create_date, "2019-03-04 07:08:09") == "2019-03-04"
    assert one(spark, S.create_hour, "2019-03-04 07:08:09") == "07"
    assert one(spark, S.create_date, "2019-03-04") == "2019-03-04"
    assert one(spark, S.create_hour, "2019-03-04") is None
    assert one(spark, S.create_hour, None) is None


def test_log_date_hour_midnight(spark):
    # 2024-01-15 23:59:59.999 UTC and 2024-01-16 00:00:00.001
    assert one(spark, S.log_date, 1705363199999, "long") == "2024-01-15"
    assert one(spark, S.log_hour, 1705363199999, "long") == "23"
    assert one(spark, S.log_date, 1705363200001, "long") == "2024-01-16"
    assert one(spark, S.log_hour, 1705363200001, "long") == "00"


def test_age_365(spark):
    # 365-day years, truncated: 365*20 days before as_of is 20, one day less is 19
    df = spark.createDataFrame([("2020-01-01",)], "as_of string")
    r = df.select(
        S.age_365(F.date_format(F.date_sub(F.to_date("as_of"), 365 * 20), "yyyy-MM-dd"),
                  "2020-01-01").alias("a"),
        S.age_365(F.date_format(F.date_sub(F.to_date("as_of"), 365 * 20 - 1), "yyyy-MM-dd"),
                  "2020-01-01").alias("b"),
        S.age_365(F.lit("2020-06-01"), "2020-01-01").alias("future"),
    ).first()
    assert (r.a, r.b, r.future) == (20, 19, 0)


def test_age_band(spark):
    got = [one(spark, S.age_band, a, "int") for a in (0, 19, 20, 30, 31)]
    assert got == ["lt20", "lt20", "20to30", "20to30", "gt30"]


def test_ratio1(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (0, 0), (1, 8)], "c long, t long")
    got = [r[0] for r in df.select(S.ratio1("c", "t")).collect()]
    assert got == [33.3, 66.7, 0.0, 12.5]


def test_prev_day_and_alert_id(spark):
    assert one(spark, S.prev_day, "2024-03-01") == "2024-02-29"
    df = spark.createDataFrame([("mid_1", 1705363199999)], "mid string, ts long")
    assert df.select(S.alert_id("mid", "ts")).first()[0] == "mid_1_28422719"


def test_tokens(spark):
    assert one(spark, S.tokens, "Red Widget-2 冷饮") == ["red", "widget", "2", "冷", "饮"]
    assert one(spark, S.tokens, "") == []


def test_sku_price(spark):
    assert one(spark, S.sku_price, "12.5") == 12.5
    assert one(spark, S.sku_price, "n/a") is None


def test_malformed_dates_give_rows_not_failures(spark):
    from pyspark.sql import functions as F
    from martlane.functions.scalar import age_365
    from martlane.plans.dashboard import today_vs_yesterday

    df = spark.createDataFrame([("1990-02-30",), ("bad",), (None,), ("2000-01-01",)], "birthday string")
    assert [r[0] for r in df.select(age_365("birthday", "2020-01-01")).collect()] == [None, None, None, 20]
    orders = spark.createDataFrame([("bad", "01", 1.0), ("2024-01-01", "02", 2.0)], "d string, h string, v double")
    got = {(r.date, r.hour): (r.today, r.yesterday) for r in today_vs_yesterday(orders, "d", "h", "v").collect()}
    assert got[("2024-01-02", "02")] == (None, 2.0) and got[("bad", "01")] == (1.0, None)


def test_first_order_flag_survives_redelivery(spark):
    from martlane.operators.orders import first_order_flag

    seen = spark.createDataFrame([("u1", "o1")], "user_id string, id string")
    again = spark.createDataFrame([("o1", "u1", "t1"), ("o2", "u1", "t2"), ("o3", "u2", "t3")],
                                  "id string, user_id string, create_time string")
    got = {r.id: r.is_first_order for r in first_order_flag(again, seen).collect()}
    assert got == {"o1": "1", "o2": "0", "o3": "1"}
