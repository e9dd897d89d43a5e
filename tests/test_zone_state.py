"""Day partials: any window equals the mart recomputed from its events."""

import pytest
from pyspark.sql import functions as F

from cityweave.operators import zones
from cityweave.plans import zone_state
from cityweave.sources import fixture
from cityweave.sources.events import flatten_events, read_events
from tests.conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("log")
    events = fixture.geo_events(spark, SF_SMALL)
    # twelve days; ids repeat across days, so keys compete over the window
    day = F.date_add(F.lit("2024-03-25").cast("date"), (F.col("event_id") % 12).cast("int"))
    shared = events.withColumn("date", day).withColumn("event", F.col("event").withField("message_id", F.col("event.message_id") % 40))
    shared.write.partitionBy("date").parquet(f"{root}/events")
    return f"{root}/events/date"


def _full(spark, base, date, depth, cities, keyed):
    events = flatten_events(read_events(spark, base, date, depth))
    return rows(zones.zone_metrics(zones.closest_event_cities(events, cities, key=zones.KEYED if keyed else None)))


@pytest.mark.parametrize("keyed", [True, False])
def test_windows_late_days_and_replays(spark, log, tmp_path, keyed):
    cities, state = fixture.cities(spark, SF_SMALL), f"{tmp_path}/state"
    copy = tmp_path / "events"
    spark.read.parquet(log.rsplit("/", 1)[0]).where("date <= '2024-04-02'").write.partitionBy("date").parquet(str(copy))
    base = f"{copy}/date"

    def run(date, depth):
        got = rows(zone_state.zone_metrics_of_window(spark, base, date, depth, cities, state, keyed))
        assert got == _full(spark, base, date, depth, cities, keyed)

    def read(date, depth):
        return zone_state.update(spark, base, date, depth, cities, state, keyed)[1]

    run("2024-03-31", 4)
    assert read("2024-04-01", 4) == ["2024-04-01"]  # a later window reads the new day alone
    assert read("2024-04-01", 5) == []  # a replay, and an older day that is there, read none
    run("2024-04-02", 7)
    # a late file changes one day; only that day is read again
    late = spark.read.parquet(log.rsplit("/", 1)[0]).where("date = '2024-04-03'").drop("date")
    late.coalesce(1).write.mode("append").parquet(f"{copy}/date=2024-03-30")
    assert read("2024-04-02", 7) == ["2024-03-30"]
    run("2024-04-02", 7)
    # another dictionary makes other partials
    fewer = cities.where("city_id <> '3'")
    assert len(zone_state.update(spark, base, "2024-04-02", 2, fewer, state, keyed)[1]) == 2
    assert rows(zone_state.zone_metrics_of_window(spark, base, "2024-04-02", 2, fewer, state, keyed)) == _full(spark, base, "2024-04-02", 2, fewer, keyed)


def test_days_without_located_events_and_killed_runs(spark, log, tmp_path, monkeypatch):
    cities, state = fixture.cities(spark, SF_SMALL), f"{tmp_path}/state"
    copy = tmp_path / "events"
    events = spark.read.parquet(log.rsplit("/", 1)[0]).where("date between '2024-03-28' and '2024-03-30'")
    gone = F.when(F.col("date") == "2024-03-29", F.lit(None)).otherwise(F.col("lat"))
    events.withColumn("lat", gone).write.partitionBy("date").parquet(str(copy))
    moved = zone_state.Folders.move

    def stop(self, source, target):
        if "2024-03-30" in target:
            raise OSError("killed")
        moved(self, source, target)

    monkeypatch.setattr(zone_state.Folders, "move", stop)
    with pytest.raises(OSError):
        zone_state.update(spark, f"{copy}/date", "2024-03-30", 3, cities, state)
    monkeypatch.undo()
    assert zone_state.update(spark, f"{copy}/date", "2024-03-30", 3, cities, state)[1] == ["2024-03-30"]
    got = rows(zone_state.zone_metrics_of_window(spark, f"{copy}/date", "2024-03-30", 3, cities, state))
    assert got == _full(spark, f"{copy}/date", "2024-03-30", 3, cities, True)
    with pytest.raises(FileNotFoundError):
        zone_state.update(spark, f"{copy}/date", "2025-01-01", 2, cities, state, missing="skip")
