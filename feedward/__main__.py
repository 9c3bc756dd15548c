"""``spark-submit`` entry: ``python -m feedward RAW_DIR OUT_DIR --as-of "2026-04-20 16:48:29"``."""

from __future__ import annotations

import argparse
from datetime import datetime

from feedward.operators.measures import holder_reliability
from feedward.plans.audit import audit_summary
from feedward.plans.layers import run_job
from feedward.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="feedward", description=__doc__)
    parser.add_argument("raw_dir", help="directory with the raw CSV tables")
    parser.add_argument("out_dir", help="shared directory that receives the layers")
    parser.add_argument("--as-of", required=True, type=datetime.fromisoformat)
    parser.add_argument("--run-at", type=datetime.fromisoformat, help="defaults to --as-of")
    parser.add_argument("--dedup", choices=("first", "keep_all"), default="first")
    args = parser.parse_args()
    spark = build_session("feedward")
    tables = run_job(
        spark, args.raw_dir, args.out_dir, args.as_of, args.run_at or args.as_of, args.dedup
    )
    audit_summary(tables["audit_log"]).show()
    holder_reliability(tables["agg_feed_health"]).show(truncate=False)


if __name__ == "__main__":
    main()
