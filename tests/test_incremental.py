"""Manifest, publication and incremental refresh."""

import os
import re

import pytest
from pyspark.sql import functions as F

from weekly_impact.plans import incremental as I
from weekly_impact.plans import queries as Q
from weekly_impact.plans import refresh as R
from weekly_impact.plans.params import FIXTURE_PARAMS, REFERENCE_PARAMS
from weekly_impact.plans.registry import CORE_QUERIES, all_events, site_events
from weekly_impact.sources import files
from weekly_impact.sources.events import read_events, write_events
from weekly_impact.sources.manifest import changed_days, list_shards
from weekly_impact.sources.publish import Publication, read_published
from weekly_impact.streaming import read_weekly_funnel, refresh_weekly_funnel, watch_weekly_funnel

SF = "/root/testdata/sf0.001"


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def shard_file(shards, day):
    """The one file of a shard, as an exporter names it."""
    folder = f"{shards}/event_date={day}"
    (name,) = [n for n in os.listdir(folder) if n.endswith(".parquet")]
    return f"{folder}/{name}"


def put(spark, df, path, tmp):
    """Write ``df`` as the single Parquet file ``path``."""
    part = f"{tmp}/one-{os.path.basename(path)}-{df.count()}"
    df.drop("event_date").coalesce(1).write.mode("overwrite").parquet(part)
    (name,) = [n for n in os.listdir(part) if n.endswith(".parquet")]
    for old in (path, f"{os.path.dirname(path)}/.{os.path.basename(path)}.crc"):
        if os.path.exists(old):
            os.unlink(old)
    os.rename(f"{part}/{name}", path)


def test_changed_days(spark):
    schema = "path string, size long, modified timestamp, event_date string"
    t0, t1 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"

    def listing(*rows):
        return spark.createDataFrame([(p, s, None, d) for p, s, _, d in rows], schema).drop("modified").join(
            spark.createDataFrame([(p, t) for p, _, t, _ in rows] or [("", t0)], "path string, t string"), "path").select(
            "path", "size", F.to_timestamp("t").alias("modified"), "event_date")

    old = listing(("a", 1, t0, "20240101"), ("b", 1, t0, "20240102"), ("c", 1, t0, "20240103"), ("d", 1, t0, "20240104"))
    new = listing(("a", 1, t0, "20240101"), ("b", 2, t0, "20240102"), ("c", 1, t1, "20240103"), ("e", 1, t0, "20240105"))
    assert sorted(r[0] for r in changed_days(old, new).collect()) == ["20240102", "20240103", "20240104", "20240105"]
    assert changed_days(old, old).count() == 0


def test_listing_skips_other_shards(spark, tmp_path):
    shards = str(tmp_path / "s")
    write_events(site_events(spark, SF), shards)
    os.makedirs(f"{shards}/event_date=intraday_20240101")
    open(f"{shards}/event_date=intraday_20240101/x.parquet", "wb").close()
    days = {r.event_date for r in list_shards(spark, shards, "20240110", "20240112").collect()}
    assert days == {"20240110", "20240111", "20240112"}
    assert list_shards(spark, str(tmp_path / "none")).count() == 0


def test_stream_follows_same_name_empty_and_deleted_shards(spark, tmp_path):
    shards, table, state = (str(tmp_path / n) for n in ("shards", "table", "state"))
    ev = site_events(spark, SF)
    days = sorted(r.event_date for r in ev.select("event_date").distinct().collect())
    write_events(ev, shards)
    assert refresh_weekly_funnel(spark, shards, table, state, "19950101")
    assert refresh_weekly_funnel(spark, shards, table, state, "19950101") == []
    rewritten, emptied, gone = days[1], days[10], days[18]
    double = ev.where(F.col("event_date") == rewritten)
    put(spark, double.unionByName(double), shard_file(shards, rewritten), tmp_path)
    put(spark, ev.where(F.col("event_date") == emptied).limit(0), shard_file(shards, emptied), tmp_path)
    os.unlink(shard_file(shards, gone))
    weeks = refresh_weekly_funnel(spark, shards, table, state, "19950101")
    assert {w.strftime("%Y%m%d") for w in weeks} == {I.monday(d).replace("-", "") for d in (rewritten, emptied, gone)}
    now = ev.where(~F.col("event_date").isin(emptied, gone)).unionByName(double)
    assert same(read_weekly_funnel(spark, table), Q.funnel_weekly(now, FIXTURE_PARAMS))


def test_watch_refreshes(spark, tmp_path):
    shards, table, state = (str(tmp_path / n) for n in ("shards", "table", "state"))
    ev = site_events(spark, SF)
    write_events(ev, shards)
    query = watch_weekly_funnel(spark, shards, table, state, str(tmp_path / "ckpt"), "19950101", every="1 second")
    try:
        for _ in range(60):
            query.awaitTermination(1)
            if Publication(spark, state).current():
                break
        assert query.exception() is None
    finally:
        query.stop()
    assert same(read_weekly_funnel(spark, table), Q.funnel_weekly(ev, FIXTURE_PARAMS))


def test_a_failed_refresh_leaves_the_old_set_and_no_scratch(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    events = all_events(spark, SF)
    names = R.refresh(spark, events, out, FIXTURE_PARAMS, fmt="parquet")
    old = {n: read_published(spark, out, n).count() for n in names}
    scratch = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    scratch = re.sub("^file:", "", os.path.dirname(scratch) if re.search(r"[0-9a-f-]{36}$", scratch) else scratch)
    before = set(os.listdir(scratch))
    write, done = R.write_result, []

    def failing(df, path, fmt):
        if len(done) == 8:
            raise RuntimeError("the ninth write")
        done.append(path)
        write(df.limit(0), path, fmt=fmt)

    monkeypatch.setattr(R, "write_result", failing)
    with pytest.raises(RuntimeError, match="ninth"):
        R.refresh(spark, events, out, FIXTURE_PARAMS, fmt="parquet")
    assert set(os.listdir(scratch)) == before
    assert len(done) == 8 and len(old) == 17
    assert {n: read_published(spark, out, n).count() for n in names} == old
    assert files.folders(spark, f"{out}/versions") == [Publication(spark, out).current()]


def test_publication_keeps_the_last_versions(spark, tmp_path):
    out = Publication(spark, str(tmp_path / "p"))
    assert out.current() is None
    with pytest.raises(FileNotFoundError):
        out.path("t")
    seen = []
    for i in range(4):
        v = out.stage()
        spark.range(i).write.parquet(out.path("t", v))
        out.swap(v)
        seen.append(v)
        assert read_published(spark, out.root, "t").count() == i
    assert files.folders(spark, f"{out.root}/versions") == seen[-2:]


def test_refresh_writes_the_run_record_and_overlays(spark, tmp_path):
    out = str(tmp_path / "out")
    R.refresh(spark, all_events(spark, SF), out, REFERENCE_PARAMS, fmt="json")
    meta = read_published(spark, out, "meta", "json").first()
    assert [c.label for c in meta.delivery_changes][:2] == ["New delivery structure", "Dining chairs increase"]
    assert [x.start for x in meta.sale_periods] == [x.start for x in REFERENCE_PARAMS.sale_periods]
    assert [t.tier for t in meta.current_delivery] == [t[0] for t in REFERENCE_PARAMS.current_tiers]
    assert read_published(spark, out, "annotated_changes", "json").count() == 5


def test_incremental_refresh_reads_only_the_new_shard(spark, tmp_path, monkeypatch):
    shards, state, out = (str(tmp_path / n) for n in ("shards", "state", "out"))
    ev = all_events(spark, SF).where("event_date between '19970310' and '19970420'")
    days = {r.event_date for r in ev.select("event_date").distinct().collect()}
    new = sorted(days)[3]
    write_events(ev.where(F.col("event_date") != new), shards)
    first = I.refresh_incremental(spark, shards, state, out, FIXTURE_PARAMS, "parquet")
    assert set(first["days"]) == days - {new}
    write_events(ev.where(F.col("event_date") == new), shards, mode="append")
    plans = []
    touched = I.touched_events

    def spy(*args):
        df = touched(*args)
        plans.append((args[2], df))
        return df

    monkeypatch.setattr(I, "touched_events", spy)
    second = I.refresh_incremental(spark, shards, state, out, FIXTURE_PARAMS, "parquet")
    assert second == {"days": [new], "weeks": [I.monday(new)]}
    ((asked, df),) = plans
    assert asked == [new]
    text = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[[^]]*event_date#\d+ = {new}", text)
    assert {re.search("event_date=([^/]+)", f).group(1) for f in df.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} == {new}
    full = str(tmp_path / "full")
    names = R.refresh(spark, read_events(spark, shards, "19950101"), full, FIXTURE_PARAMS, "parquet")
    assert set(CORE_QUERIES) < set(names)
    for n in set(names) - {"meta"}:
        assert same(read_published(spark, out, n), read_published(spark, full, n)), n


def test_incremental_refresh_follows_rewrites_and_deletions(spark, tmp_path):
    shards, state, out, full = (str(tmp_path / n) for n in ("shards", "state", "out", "full"))
    ev = all_events(spark, SF).where("event_date between '19970310' and '19970420'")
    write_events(ev, shards)
    I.refresh_incremental(spark, shards, state, out, FIXTURE_PARAMS, "parquet")
    days = sorted(r.event_date for r in ev.select("event_date").distinct().collect())
    again, emptied, gone = days[3], days[8], days[-3]
    put(spark, ev.where(F.col("event_date") == days[4]), shard_file(shards, again), tmp_path)
    put(spark, ev.limit(0), shard_file(shards, emptied), tmp_path)
    os.unlink(shard_file(shards, gone))
    done = I.refresh_incremental(spark, shards, state, out, FIXTURE_PARAMS, "parquet")
    assert done["days"] == [again, emptied, gone]
    names = R.refresh(spark, read_events(spark, shards, "19950101"), full, FIXTURE_PARAMS, "parquet")
    for n in set(names) - {"meta"}:
        assert same(read_published(spark, out, n), read_published(spark, full, n)), n
    parts = [f"{d}/{x}" for d, subs, _ in os.walk(f"{state}/parts/fact") for x in subs if x.startswith("event_date=")]
    assert len(parts) == len({p.rsplit("=", 1)[1] for p in parts}) == len(days) - 2  # replaced parts are gone
    other = I.refresh_incremental(spark, shards, state, out, FIXTURE_PARAMS.__class__(**{**FIXTURE_PARAMS.__dict__, "start": "19970101", "start_recent": "19970101"}), "parquet")
    assert len(other["days"]) == len(days) - 1  # other bounds: all of it again (the emptied shard is a file still)
    assert {k: len(files.folders(spark, f"{state}/parts/{k}")) for k in I.PARTITIONED} == dict.fromkeys(I.PARTITIONED, 1)  # the old bounds' parts are gone


def test_parts_of_a_failed_run_go_with_the_next_one(spark, tmp_path, monkeypatch):
    shards, state, out = (str(tmp_path / n) for n in ("shards", "state", "out"))
    write_events(all_events(spark, SF).where("event_date between '19970310' and '19970323'"), shards)

    def failing(*args):
        raise RuntimeError("no room")

    with monkeypatch.context() as m:
        m.setattr(I, "publish_results", failing)
        with pytest.raises(RuntimeError, match="no room"):
            I.refresh_incremental(spark, shards, state, out, FIXTURE_PARAMS, "parquet")
    assert Publication(spark, state).current() is None
    left = {k: files.folders(spark, f"{state}/parts/{k}") for k in I.PARTITIONED}
    assert all(left.values())
    assert I.refresh_incremental(spark, shards, state, out, FIXTURE_PARAMS, "parquet")["days"]
    now = {k: files.folders(spark, f"{state}/parts/{k}") for k in I.PARTITIONED}
    assert all(len(now[k]) == 1 and now[k] != left[k] for k in I.PARTITIONED)
    assert I.refresh_incremental(spark, shards, state, out, FIXTURE_PARAMS, "parquet")["days"] == []
