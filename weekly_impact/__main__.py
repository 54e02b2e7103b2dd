"""``python -m weekly_impact refresh --events PATH --out DIR [--state DIR] [--params FILE] [--format json|parquet]``

Runs the 14 results over a GA4-style event table laid out as daily
``event_date=YYYYMMDD`` Parquet shards and publishes one result directory per
query (``DIR/versions/<version>/<query>``; ``DIR/CURRENT`` names the version to
read).  With ``--state`` the run is incremental: only changed shards are read.  The session is whatever ``spark-submit`` configured (``getOrCreate``);
parameters default to the published configuration and can be overridden by a
JSON file whose keys are :class:`weekly_impact.plans.params.Params` fields,
for example::

    {"start": "20230101", "blocklist": ["shop", "Sofas"],
     "changes": [{"date": "2025-04-01", "label": "Apr 2025", "categories": ["BEDS"]}],
     "funnel_changes": [{"date": "2025-04-01", "label": "Apr 2025"}],
     "tiers": [{"tier": "Large", "values": ["Sofas"], "column": "subcategory"}],
     "top_products": 500}
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys

from pyspark.sql import SparkSession

from .functions.tiers import TierRule
from .plans.incremental import refresh_incremental
from .plans.params import REFERENCE_PARAMS, Params
from .plans.refresh import refresh
from .session import JOB_CONF, ensure_checkpoint_dir
from .sources.dimensions import Change, SalePeriod
from .sources.events import read_events


def load_params(path: str | None) -> Params:
    if not path:
        return REFERENCE_PARAMS
    with open(path, encoding="utf-8") as f:
        raw = json.load(f)
    conv = {
        "changes": lambda v: tuple(Change(c["date"], c["label"], tuple(c.get("categories", ()))) for c in v),
        "funnel_changes": lambda v: tuple(Change(c["date"], c["label"]) for c in v),
        "tiers": lambda v: tuple(TierRule(t["tier"], tuple(t["values"]), t.get("column", "subcategory")) for t in v),
        "sale_periods": lambda v: tuple(SalePeriod(x["start"], x["end"], x["label"], x.get("detail", "")) for x in v),
        "delivery_changes": lambda v: tuple(Change(c["date"], c["label"], detail=c.get("detail", "")) for c in v),
        "current_tiers": lambda v: tuple((t["tier"], t["price"], t["carrier"], t["examples"]) for t in v),
        "blocklist": tuple,
    }
    known = {f.name for f in dataclasses.fields(Params)}
    unknown = set(raw) - known
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    return dataclasses.replace(REFERENCE_PARAMS, **{k: conv.get(k, lambda v: v)(v) for k, v in raw.items()})


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m weekly_impact")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh", help="compute and write the 14 weekly results")
    r.add_argument("--events", required=True, help="event table: Parquet shards partitioned by event_date")
    r.add_argument("--out", required=True, help="output directory (one sub-directory per result)")
    r.add_argument("--state", help="folder kept between runs: only changed shards are read")
    r.add_argument("--params", help="JSON file overriding the default parameters")
    r.add_argument("--format", default="json", choices=["json", "parquet"])
    args = ap.parse_args(argv)

    p = load_params(args.params)
    spark = SparkSession.builder.appName("weekly_impact refresh").getOrCreate()
    for key, value in JOB_CONF.items():  # UTC dates and ANSI arithmetic, whatever the submit defaults are
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    if args.state:
        done = refresh_incremental(spark, args.events, args.state, args.out, p, fmt=args.format)
    else:
        events = read_events(spark, args.events, start=min(p.start, p.start_recent), end=p.end)
        done = {"written": refresh(spark, events, args.out, p, fmt=args.format)}
    print(json.dumps({**done, "out": args.out}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
