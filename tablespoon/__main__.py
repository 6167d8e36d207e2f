"""``python -m tablespoon --phase trans --date 2024-01-20 --lake /data/lake``"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging

from tablespoon.operators.standardize import local_day
from tablespoon.plans import jobs
from tablespoon.schemas import SPECS, specs_from_config
from tablespoon.session import session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tablespoon", description="Runs one job of the sales lakehouse.")
    parser.add_argument("--phase", required=True, choices=["master", "trans", "build", "daily", "backfill"])
    parser.add_argument("--date", help="landed day, yyyy-MM-dd; needed by trans and daily")
    parser.add_argument("--lake", required=True, help="root folder holding landing/, bronze/ and marts/")
    parser.add_argument("--config", help="JSON config with mapping sections and the branch map")
    parser.add_argument("--input-gb", type=int, default=0, help="about how much the job reads, for sizing")
    parser.add_argument("--cores", type=int, default=0, help="cores of the cluster, for sizing")
    parser.add_argument("--days", type=int, help="lookback of build (3) and backfill (7)")
    args = parser.parse_args(argv)
    if args.phase in ("trans", "daily"):
        if not args.date:
            parser.error(f"--date is needed for phase {args.phase}")
        dt.date.fromisoformat(args.date)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")

    branch_map, specs = {}, SPECS
    if args.config:
        with open(args.config, encoding="utf-8") as f:
            config = json.load(f)
        branch_map = config.get("Branch-Name_Mapper", {})
        specs = {**SPECS, **specs_from_config(config)}
    root = args.lake.rstrip("/")
    lake = jobs.Lake(f"{root}/landing", f"{root}/bronze", f"{root}/marts", branch_map, specs)
    spark = session("tablespoon", input_bytes=args.input_gb << 30, cores=args.cores)
    today = local_day(dt.datetime.now(dt.timezone.utc))
    if args.phase == "master":
        jobs.run_master(spark, lake)
    elif args.phase == "trans":
        jobs.run_transactions(spark, lake, args.date)
    elif args.phase == "build":
        jobs.build(spark, lake, today, args.days or 3)
    elif args.phase == "daily":
        jobs.run_daily(spark, lake, args.date, backfill_days=args.days or 3)
    else:
        jobs.backfill_range(spark, lake, today, args.days or 7)


if __name__ == "__main__":
    main()
