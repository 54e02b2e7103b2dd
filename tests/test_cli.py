"""``python -m weekly_impact refresh`` over daily event shards."""

import json

from weekly_impact.__main__ import load_params, main
from weekly_impact.plans.params import FIXTURE_PARAMS
from weekly_impact.plans.registry import CORE_QUERIES, all_events
from weekly_impact.sources.events import write_events
from weekly_impact.sources.publish import read_published

SF = "/root/testdata/sf0.001"


def _params_json(p):
    return {
        "start": p.start,
        "start_recent": p.start_recent,
        "blocklist": list(p.blocklist),
        "top_products": p.top_products,
        "top_units": p.top_units,
        "top_impact_products": p.top_impact_products,
        "top_funnel_products": p.top_funnel_products,
        "changes": [{"date": c.date, "label": c.label, "categories": list(c.categories)} for c in p.changes],
        "funnel_changes": [{"date": c.date, "label": c.label} for c in p.funnel_changes],
        "tiers": [{"tier": t.tier, "values": list(t.values), "column": t.column} for t in p.tiers],
    }


def test_params_round_trip(tmp_path):
    f = tmp_path / "p.json"
    f.write_text(json.dumps(_params_json(FIXTURE_PARAMS)))
    p = load_params(str(f))
    assert (p.changes, p.tiers, p.blocklist, p.top_units) == (
        FIXTURE_PARAMS.changes, FIXTURE_PARAMS.tiers, FIXTURE_PARAMS.blocklist, FIXTURE_PARAMS.top_units)


def test_refresh_command(spark, tmp_path):
    shards = str(tmp_path / "events")
    write_events(all_events(spark, SF), shards)
    pf = tmp_path / "p.json"
    pf.write_text(json.dumps(_params_json(FIXTURE_PARAMS)))
    out = str(tmp_path / "out")
    assert main(["refresh", "--events", shards, "--out", out, "--params", str(pf), "--format", "parquet"]) == 0
    got = read_published(spark, out, "category_weekly")
    want = CORE_QUERIES["category_weekly"](spark, SF)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_refresh_command_with_state(spark, tmp_path):
    shards, out = str(tmp_path / "events"), str(tmp_path / "out")
    write_events(all_events(spark, SF).where("event_date between '19970310' and '19970331'"), shards)  # one folder a day
    pf = tmp_path / "p.json"
    pf.write_text(json.dumps(_params_json(FIXTURE_PARAMS)))
    args = ["refresh", "--events", shards, "--out", out, "--params", str(pf), "--format", "parquet"]
    assert main([*args, "--state", str(tmp_path / "state")]) == 0
    kept = read_published(spark, out, "category_weekly").collect()
    assert main([*args, "--state", str(tmp_path / "state")]) == 0
    assert kept and read_published(spark, out, "category_weekly").collect() == kept
