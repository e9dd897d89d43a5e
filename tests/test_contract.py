"""Day layouts reconciled with the declared event schema."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cityweave.sources.contract import EVENT_CONTRACT, conflicts
from cityweave.sources.events import flatten_events, read_events

BASE = "named_struct('message_id', {id}, 'message_from', {user}, 'message_ts', '2022-06-01 10:00:00'{more})"


def write_day(spark, root, day, event, lat="double(-33.5)", mode="error", also=""):
    columns = f"{event} AS event, 'message' AS event_type, {lat} AS lat, double(151) AS lon{also}"
    spark.sql(f"SELECT {columns}").write.mode(mode).parquet(f"{root}/date={day}")


def three_layouts(spark, root):
    write_day(spark, root, "2022-06-01", BASE.format(id="int(1)", user="smallint(7)", more=""), lat="float(-33.5)")
    write_day(spark, root, "2022-06-02", BASE.format(id="3000000000", user="8L", more=", 'message_to', 9L, 'datetime', 'x', 'tags', array('a')"), also=", 'v2' AS layout")
    write_day(spark, root, "2022-06-03", BASE.format(id="3L", user="int(9)", more=", 'user', 'u', 'subscription_channel', int(5), 'reaction_from', 'r'"), lat="int(-33)")


def test_a_window_of_three_layouts(spark, tmp_path):
    root = str(tmp_path / "events")
    three_layouts(spark, root)
    events = read_events(spark, f"{root}/date", "2022-06-03", 3, contract=EVENT_CONTRACT)
    assert events.select(*[c for c in events.columns if c != "date"]).schema.simpleString() == StructType.fromDDL(EVENT_CONTRACT).simpleString()
    names = ("message_id", "message_from", "message_to", "datetime", "usr", "subscription_channel", "reaction_from", "lat", "lon")
    got = flatten_events(events).orderBy("date").select(F.col("date").cast("string"), *names).collect()
    assert [tuple(r) for r in got] == [
        ("2022-06-01", 1, 7, None, None, None, None, None, -33.5, 151.0),
        ("2022-06-02", 3000000000, 8, 9, "x", None, None, None, -33.5, 151.0),
        ("2022-06-03", 3, 9, None, None, "u", 5, "r", -33.0, 151.0),
    ]


def test_fields_added_within_a_day(spark, tmp_path):
    root = str(tmp_path / "events")
    write_day(spark, root, "2022-06-01", BASE.format(id="1L", user="7L", more=""))
    write_day(spark, root, "2022-06-01", BASE.format(id="2L", user="8L", more=", 'message_to', 9L"), mode="append")
    got = flatten_events(read_events(spark, f"{root}/date", "2022-06-01", 1, contract=EVENT_CONTRACT))
    assert sorted((r["message_id"], r["message_to"]) for r in got.collect()) == [(1, None), (2, 9)]


def test_types_that_do_not_fit_are_refused(spark, tmp_path):
    root = str(tmp_path / "events")
    three_layouts(spark, root)
    write_day(spark, root, "2022-06-04", BASE.format(id="'4'", user="7L", more=", 'message_to', double(1)"))
    with pytest.raises(ValueError, match="event.message_id is string, not bigint.*event.message_to is double, not bigint"):
        read_events(spark, f"{root}/date", "2022-06-04", 4, contract=EVENT_CONTRACT)
    read_events(spark, f"{root}/date", "2022-06-03", 3, contract=EVENT_CONTRACT)  # the days before are fine


def test_a_day_of_files_that_disagree_is_refused(spark, tmp_path):
    root = str(tmp_path / "events")
    write_day(spark, root, "2022-06-01", BASE.format(id="1L", user="7L", more=""))
    write_day(spark, root, "2022-06-01", BASE.format(id="'2'", user="7L", more=""), mode="append")
    with pytest.raises(ValueError, match="2022-06-01"):
        read_events(spark, f"{root}/date", "2022-06-01", 1, contract=EVENT_CONTRACT)


def test_conflicts_inside_lists_and_maps():
    def types(ddl):
        return StructType.fromDDL(ddl)

    declared = "a array<struct<x: bigint>>, m map<string, double>, s string"
    assert conflicts(types("A array<struct<x: int>>, m map<string, float>"), types(declared)) == []
    assert conflicts(types("a array<struct<x: string>>, m map<int, double>, s int"), types(declared)) == [
        ("a.element.x", "string", "bigint"),
        ("m.key", "int", "string"),
        ("s", "int", "string"),
    ]
