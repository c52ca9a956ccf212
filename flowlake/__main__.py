"""Run the model graph: ``python -m flowlake --catalog cat.json --seeds DIR --out DIR``.

``cat.json`` maps logical source names (``schema.table``) to Parquet paths or
table names. ``DIR`` holds the seed CSVs. Each run picks the incremental
branch per model when its table exists (``--full-refresh`` forces rebuilds),
then optionally runs the declared data tests and exits non-zero on failures.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

SEED_FILES = {"yield_tokens": "erc20_yielding_stablecoins.csv",
              "rwa_tokens": "erc20_rwa_tokens.csv",
              "spl_tokens": "spl_rwa_tokens.csv"}


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="flowlake", description=__doc__.splitlines()[0])
    p.add_argument("--catalog", required=True, help="JSON file: source name → path")
    p.add_argument("--seeds", required=True, help="folder with the seed CSV files")
    p.add_argument("--out", required=True, help="folder (or bucket prefix) for model tables")
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    p.add_argument("--lookback-days", type=int, default=2)
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--select", choices=["all", "yield", "tether"], default="all")
    p.add_argument("--test", action="store_true", help="run the declared data tests afterwards")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    from flowlake.context import RunContext
    from flowlake.plans import defaults
    from flowlake.plans.dag import run_model_tests, run_tether_models, run_yield_models
    from flowlake.session import build_session
    from flowlake.sources.catalog import Catalog
    from flowlake.sources.seeds import read_seed

    spark = build_session()
    with open(args.catalog) as f:
        catalog = Catalog(spark, json.load(f), aliases=defaults.SOURCE_ALIASES)
    ctx = RunContext(as_of=args.as_of, lookback_days=args.lookback_days)
    outputs = {}
    if args.select in ("all", "yield"):
        seeds = {k: read_seed(spark, os.path.join(args.seeds, v), k)
                 for k, v in SEED_FILES.items() if os.path.exists(os.path.join(args.seeds, v))}
        outputs.update(run_yield_models(spark, catalog, seeds["yield_tokens"], seeds["rwa_tokens"],
                                        seeds.get("spl_tokens"), ctx, args.out, args.full_refresh))
    if args.select in ("all", "tether"):
        outputs.update(run_tether_models(spark, catalog, ctx, args.out,
                                         full_refresh=args.full_refresh))
    if args.test:
        failed = [(r["test"], r["n_failed"]) for r in run_model_tests(outputs).collect()
                  if r["n_failed"]]
        for name, n in failed:
            print(f"FAIL {name}: {n} rows", file=sys.stderr)
        return 1 if failed else 0
    return 0


if __name__ == "__main__":
    sys.exit(main())
