"""Command line for the layer jobs: ``python -m tessera <step> --root <lakehouse> ...``.

Steps: ``landing``, ``bronze-price``, ``bronze-index``, ``validate-bronze``,
``silver``, ``gold``.
The master is whatever the submitting environment sets (spark-submit or
``--master``); run ids default to a fresh UUID.
"""

from __future__ import annotations

import argparse
import json
import uuid

from tessera.plans import layers, refresh
from tessera.session import get_session, size_for


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m tessera")
    p.add_argument("--master", default=None)
    p.add_argument("--root", required=True, help="lakehouse root folder")
    p.add_argument("--fmt", default="parquet")
    sub = p.add_subparsers(dest="step", required=True)

    s = sub.add_parser("landing", help="raw sheets -> canonical landing rows + ledger")
    s.add_argument("--raw", required=True)
    s.add_argument("--landing", required=True)
    s.add_argument("--ledger", required=True)
    s.add_argument("--glob", default="*.csv")
    s.add_argument("--sep", default=",")

    s = sub.add_parser("bronze-price", help="landing root + ledger -> bronze price")
    s.add_argument("--landing", required=True)
    s.add_argument("--ledger", required=True)
    s.add_argument("--run-id", default=None)

    s = sub.add_parser("bronze-index", help="JSON payload -> bronze index")
    s.add_argument("--payload", required=True)
    s.add_argument("--meta", required=True, help="JSON object: source, series_id, data_inicial, ...")

    sub.add_parser("validate-bronze", help="schema contracts of the bronze tables (+ catalog)")
    sub.add_parser("silver", help="bronze -> silver (+ catalog)")
    s = sub.add_parser("gold", help="silver -> gold tables + dashboard view")
    s.add_argument("--how", default="inner", choices=["inner", "left"])
    sub.add_parser("refresh", help="silver and gold for the years with new bronze rows (+ catalog)")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = get_session(args.master, app_name=f"tessera-{args.step}")
    lake = layers.Lakehouse(args.root, fmt=args.fmt)
    size_for(spark, *[x for x in (args.root, *map(vars(args).get, ("raw", "landing", "payload"))) if x])
    if args.step == "landing":
        out = {"new_files": layers.run_landing(spark, args.raw, args.landing, args.ledger, args.glob, args.sep)}
    elif args.step == "bronze-price":
        run_id = args.run_id or str(uuid.uuid4())
        out = {"rows": layers.run_bronze_from_landing(spark, lake, args.landing, args.ledger, run_id)}
    elif args.step == "bronze-index":
        meta = json.loads(args.meta)
        meta.setdefault("ingest_run_id", str(uuid.uuid4()))
        out = {"appended": layers.run_bronze_index(spark, lake, args.payload, meta)}
    elif args.step == "validate-bronze":
        rows = layers.run_validate_bronze(spark, lake).collect()
        out = {"not_ok": [r.asDict() for r in rows if r["status"] not in ("ok", "extra")]}
    elif args.step == "silver":
        out = layers.run_silver(spark, lake)
    elif args.step == "refresh":
        done = refresh.run_refresh(spark, lake)
        out = {"silver_years": list(done.silver), "gold_years": list(done.gold), "full": done.full}
    else:
        out = {"dashboard_rows": layers.run_gold(spark, lake, args.how).count()}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
