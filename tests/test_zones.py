from pyspark.sql import functions as F

from cityweave.operators.zones import zone_metrics, zone_month_metrics, zone_week_metrics
from tests.conftest import SF_SMALL, rows

SCHEMA = "message_ts string, datetime string, city_id string, event_type string"


def test_week_split_over_two_months_and_null_time(spark):
    data = [
        ("2024-01-31 10:00:00", None, "1", "message"),   # ISO week 5, January
        (None, "2024-02-01 10:00:00", "1", "reaction"),  # ISO week 5, February
        (None, "2024-02-02 10:00:00", "1", "registration"),
        (None, None, "1", "subscription"),               # no time: NULL month and week
    ]
    df = spark.createDataFrame(data, SCHEMA)
    got = rows(zone_metrics(df))
    assert got == [
        (1, 5, "1", 1, 0, 0, 0, 1, 0, 0, 0),
        (2, 5, "1", 0, 1, 0, 1, 0, 1, 0, 1),
        (None, None, "1", None, None, None, None, 0, 0, 1, 0),
    ]


def test_zone_metrics_equals_month_left_join_week(spark):
    from cityweave.plans.catalog import _closest_events

    closest = _closest_events(spark, SF_SMALL)
    m = zone_month_metrics(closest)
    w = zone_week_metrics(closest)
    joined = m.join(w, ["month", "zone_id"], "left").select(
        "month", "week", "zone_id", "week_message", "week_reaction", "week_subscription", "week_user",
        "month_message", "month_reaction", "month_subscription", "month_user",
    )
    ours = zone_metrics(closest)
    assert ours.exceptAll(joined).count() == 0 and joined.exceptAll(ours).count() == 0
    # property: week counts of a (month, zone) add up to the month count
    sums = ours.where("month is not null").groupBy("month", "zone_id").agg(
        F.sum("week_message").alias("s"), F.first("month_message").alias("m")
    )
    assert sums.where("s != m").count() == 0


def test_month_has_no_year_unless_asked(spark):
    data = [("2022-12-05 10:00:00", None, "1", "message"), ("2023-12-05 10:00:00", None, "1", "message")]
    df = spark.createDataFrame(data, SCHEMA)
    merged = rows(zone_month_metrics(df), "month", "month_message")
    assert merged == [(12, 2)]
    split = rows(zone_month_metrics(df, calendar="year_month"), "year", "month", "month_message")
    assert split == [(2022, 12, 1), (2023, 12, 1)]
    assert rows(zone_metrics(df, calendar="year_month"), "year", "week", "week_message", "month_message") == [
        (2022, 49, 1, 1), (2023, 49, 1, 1)]
