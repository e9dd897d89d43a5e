import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from cityweave.operators import zones as zone_ops
from cityweave.plans import catalog, jobs, oracle
from cityweave.plans.audit import StageAudit
from cityweave.plans.jobs import run_profile_job, run_recommendation_job, run_zone_job
from cityweave.sources import fixture
from cityweave.sources.cities import read_cities
from cityweave.sources.events import day_paths, read_events
from cityweave.sources.sinks import write_mart
from tests.conftest import SF_SMALL, rows


def test_day_paths():
    assert day_paths("2022-06-21", 3, "/x/events/date/") == [
        "/x/events/date=2022-06-21", "/x/events/date=2022-06-20", "/x/events/date=2022-06-19"]
    assert day_paths("2022-06-21", 1, "/x/date") == ["/x/date=2022-06-21"]
    with pytest.raises(ValueError):
        day_paths("2022-06-21", 0, "/x/date")


def _write_days(spark, root, days):
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "d string, v int")
    df.withColumn("date", F.col("d")).drop("d").write.partitionBy("date").parquet(str(root))


def test_read_events_window_with_gap(spark, tmp_path):
    root = tmp_path / "events"
    _write_days(spark, root, ["2022-06-19", "2022-06-21", "2022-06-22"])  # 06-20 missing
    base = f"{root}/date/"
    with pytest.raises(FileNotFoundError, match="2022-06-20"):
        read_events(spark, base, "2022-06-21", 3)
    with pytest.warns(UserWarning, match="2022-06-20"):
        got = read_events(spark, base, "2022-06-21", 3, missing="skip")
    assert sorted(r.v for r in got.collect()) == [0, 1]
    assert "date" in got.columns
    # only the window's own folders are listed
    assert {f.split("date=")[1][:10] for f in got.inputFiles()} == {"2022-06-19", "2022-06-21"}
    one = read_events(spark, base, "2022-06-21", 1, schema="v int, date date")
    assert [r.v for r in one.collect()] == [1]
    both = read_events(spark, base, "2022-06-22", 2)
    assert sorted((str(r.date), r.v) for r in both.collect()) == [("2022-06-21", 1), ("2022-06-22", 2)]
    with pytest.raises(ValueError):
        read_events(spark, base, "2022-06-21", 0)


@pytest.mark.parametrize("job", [run_profile_job, run_recommendation_job, run_zone_job])
def test_a_window_without_any_day_leaves_the_mart_alone(spark, tmp_path, job):
    _write_days(spark, tmp_path / "events", ["2022-06-19"])
    csv, out = tmp_path / "geo.csv", str(tmp_path / "mart")
    csv.write_text("id;city;lat;lng\n1;Sydney;-33,865;151,2094\n")
    spark.range(7).write.parquet(out)
    for missing in ("error", "skip"):
        with pytest.raises(FileNotFoundError):
            job(spark, "2023-01-05", 3, f"{tmp_path}/events/date", str(csv), out, missing=missing)
    assert spark.read.parquet(out).count() == 7


def test_read_cities_csv(spark, tmp_path):
    p = tmp_path / "geo.csv"
    p.write_text("id;city;lat;lng\n1;Sydney;-33,865;151,2094\n2;Nowhere;;151,0\n3;Bad;x,1;2,0\n"
                 "4;Extra;-37,8136;144,9631;junk\n")
    got = rows(read_cities(spark, str(p)))
    assert got == [("1", "Sydney", -33.865, 151.2094), ("4", "Extra", -37.8136, 144.9631)]
    bad = tmp_path / "bad.csv"
    bad.write_text("city;id;lat;lng\nSydney;1;-33,865;151,2094\n")
    with pytest.raises(Exception):
        read_cities(spark, str(bad)).collect()


def test_preview_limits_rows(spark):
    from cityweave.sources.sinks import preview

    assert preview(spark.range(100), 7).count() == 7


def test_a_killed_write_leaves_the_previous_mart(spark, tmp_path, monkeypatch):
    from cityweave.sources import sinks

    out = str(tmp_path / "mart")
    assert write_mart(spark.range(7), out, rows=7) == 7
    broken = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_mart(broken, out)
    with pytest.raises(RuntimeError, match="expected"):
        write_mart(spark.range(5), out, rows=lambda: 6)
    moved, calls = sinks.Folders.move, []

    def fail(self, source, target):
        calls.append(target)
        if len(calls) == 2:  # the staged mart can't take its place
            raise OSError("no rename")
        moved(self, source, target)

    monkeypatch.setattr(sinks.Folders, "move", fail)
    with pytest.raises(OSError):
        write_mart(spark.range(5), out)
    monkeypatch.undo()
    assert spark.read.parquet(out).count() == 7
    assert [p.name for p in tmp_path.iterdir()] == ["mart"]
    assert write_mart(spark.range(3), out) == 3 and spark.read.parquet(out).count() == 3


def test_write_mart_overwrites_and_refuses_own_input(spark, tmp_path):
    out = str(tmp_path / "mart")
    write_mart(spark.range(3), out)
    write_mart(spark.range(5), out)
    assert spark.read.parquet(out).count() == 5
    for other in (out, f"file://{out}", f"file:{out}/", f"{out}/part", str(tmp_path), f"file://{tmp_path}//"):
        with pytest.raises(ValueError):
            write_mart(spark.range(1), out, inputs=(other,))
    write_mart(spark.range(1), out, inputs=(f"{out}-other",))


def test_stage_counts_of_an_empty_stage(spark, tmp_path):
    audit = StageAudit()
    audit.track("none", spark.range(3).where("false")).write.parquet(str(tmp_path / "a"))
    assert audit.counts() == {"none": 0}


def test_job_arguments(monkeypatch):
    seen = {}
    for name, (_, depth) in jobs.JOBS.items():
        monkeypatch.setitem(jobs.JOBS, name, (lambda *a, **k: seen.update(args=a, options=k) or {}, depth))
    assert jobs.main(["jobs", "profile", "2022-06-21", "/e/date", "/c.csv", "/out", "--time-fields", "message_ts", "datetime"]) == 0
    assert seen["args"][1:] == ("2022-06-21", 90, "/e/date", "/c.csv", "/out")
    assert seen["options"] == {"missing": "error", "tz": "Australia/Sydney", "time_fields": ("message_ts", "datetime")}
    jobs.main(["jobs", "zones", "2022-06-21", "/e/date", "/c.csv", "/out", "--depth", "3", "--per-row", "--missing", "skip"])
    assert seen["args"][2] == 3 and seen["options"] == {"missing": "skip", "keyed": False}


def test_jobs_end_to_end_match_catalog(spark, tmp_path):
    # production layout: nested events partitioned by day, city CSV with decimal commas
    events_root = tmp_path / "events"
    fixture.geo_events(spark, SF_SMALL).drop("event_id").write.partitionBy("date").parquet(str(events_root))
    csv = tmp_path / "geo.csv"
    lines = ["id;city;lat;lng"] + [f"{r.id};{r.city};{r.lat};{r.lng}"
                                  for r in fixture.city_text(spark, SF_SMALL).collect()]
    csv.write_text("\n".join(lines) + "\n")
    base = f"{events_root}/date/"
    end = dt.date(2024, 6, 1)
    depth = (end - dt.date(2023, 11, 1)).days + 1  # the whole fixture
    counts = run_zone_job(spark, end.isoformat(), depth, base, str(csv), str(tmp_path / "zones"), missing="skip")
    zones = spark.read.parquet(str(tmp_path / "zones"))
    want = catalog.zone_metrics(spark, SF_SMALL)
    assert zones.exceptAll(want).count() == 0 and want.exceptAll(zones).count() == 0
    assert counts["zones"] == want.count() and counts["events"] == 1000

    closest = zone_ops.closest_event_cities(catalog._inputs(spark, SF_SMALL)[0], fixture.cities(spark, SF_SMALL))
    assert counts["dict_cities"] == 25 and counts["located_events"] == 980 and counts["closest_cities"] == closest.count()
    assert counts["week_metrics"] == zone_ops.zone_week_metrics(closest).count() and counts["month_metrics"] == zone_ops.zone_month_metrics(closest).count()
    counts = run_profile_job(spark, end.isoformat(), depth, base, str(csv), str(tmp_path / "profile"), missing="skip")
    prof = spark.read.parquet(str(tmp_path / "profile"))
    assert prof.count() == counts["profile"] == catalog.user_geo_profile(spark, SF_SMALL).count()
    assert counts["closest_cities"] == catalog.nearest_city_messages(spark, SF_SMALL).count()
    assert counts["messages"] == catalog.event_projection(spark, SF_SMALL).count() and counts["dict_cities"] == 25
    assert counts["home_cities"] == catalog.home_city(spark, SF_SMALL).count()
    assert counts["act_cities"] == counts["user_cities"] == counts["travel_stats"] == counts["profile"]
    with pytest.raises(ValueError):
        run_zone_job(spark, end.isoformat(), depth, base, str(csv), f"{events_root}/date=2024-01-01", missing="skip")

    counts = run_recommendation_job(spark, end.isoformat(), depth, base, str(csv), str(tmp_path / "rec"),
                                    as_of="2024-05-01 12:00:00", missing="skip")
    con = duckdb.connect()
    for t in ("events", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    stages = {"events": "ge", "dict_cities": "cities", "user_channels": "uc", "channel_pairs": "chpairs", "contact_pairs": "cp",
              "pairs_without_contact": "nocontact", "latest_actions": "la", "located_pairs": "pdist", "nearby_pairs": "nb",
              "zoned_pairs": "nbz", "recommendations": "nbz"}
    found = con.execute(f"{oracle.BASE} SELECT {', '.join(f'(SELECT count(*) FROM {v}) AS {k}' for k, v in stages.items())}").fetchone()
    assert counts == dict(zip(stages, found, strict=True))
    rec = spark.read.parquet(str(tmp_path / "rec")).select(
        "user_left", "user_right", F.col("processed_dttm").cast("string"), "zone_id",
        F.col("local_time").cast("timestamp_ntz"))
    want = catalog.pair_recommendations(spark, SF_SMALL)
    assert rec.exceptAll(want).count() == 0 and want.exceptAll(rec).count() == 0


def test_sql_views(spark):
    from cityweave.plans.catalog import _inputs
    from cityweave.plans.views import register_views

    events, cities = _inputs(spark, SF_SMALL)
    names = register_views(spark, events, cities, prefix="t_", as_of="2024-05-01 12:00:00")
    assert "t_zones" in names
    n = spark.sql("SELECT count(*) AS n FROM t_zones").first().n
    assert n == catalog.zone_metrics(spark, SF_SMALL).count()
    assert spark.sql("SELECT count(*) FROM t_recommendations WHERE user_left >= user_right").first()[0] == 0


def test_cluster_conf_scales_with_shuffle_size():
    from cityweave.session import cluster_conf

    small = cluster_conf(10 * 1024**2, cores=8)
    big = cluster_conf(10 * 1024**4, cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == 40960


def test_nested_fields_are_pruned_in_the_scan(spark, tmp_path):
    from cityweave.operators.social import user_channels
    from cityweave.sources.events import flatten_events

    root = tmp_path / "events"
    fixture.geo_events(spark, SF_SMALL).drop("event_id").write.partitionBy("date").parquet(str(root))
    events = flatten_events(read_events(spark, f"{root}/date", "2024-01-31", 31, missing="skip"))
    df = user_channels(events)
    df.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = [line for line in plan.split("\n") if "FileScan" in line][0].split("ReadSchema: ")[1]
    assert "user" in schema and "subscription_channel" in schema
    for unused in ("message_ts", "reaction_from", "message_to", "lat"):
        assert unused not in schema
