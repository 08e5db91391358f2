"""Full run (E8), the counterpart of the reference's ``main.py``.

    python -m basketry --out OUT_DIR --snapshot DAY --tenure-date DAY
        (--sf-dir DIR | --customers CSV --transactions CSV)

``--sf-dir`` reads the driver tables through the dirty-fixture mapping
(FIXTURES.md §4), so cleaning and validation have something to do;
``--customers/--transactions`` read raw CSV files (S1).  Outputs: processed
tables, segments, churn predictions, models and BI exports under OUT_DIR.
"""

from __future__ import annotations

import argparse
import json
import time

from basketry.plans import jobs
from basketry.session import get_session
from basketry.sources import readers, tables


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="basketry")
    ap.add_argument("--out", required=True)
    ap.add_argument("--sf-dir")
    ap.add_argument("--customers")
    ap.add_argument("--transactions")
    ap.add_argument("--snapshot", required=True, help="recency is counted up to this day (yyyy-mm-dd)")
    ap.add_argument("--tenure-date", required=True, help="tenure is counted up to this day (yyyy-mm-dd)")
    args = ap.parse_args(argv)
    spark = get_session()
    t0 = time.time()
    if args.sf_dir:
        raw_c = tables.raw_customers(spark, args.sf_dir)
        raw_t = tables.raw_transactions(spark, args.sf_dir)
    else:
        raw_c, raw_t = readers.extract_data(spark, args.customers, args.transactions)
        for path, schema, name in ((args.customers, readers.CUSTOMER_SCHEMA, "customers"), (args.transactions, readers.TRANSACTION_SCHEMA, "transactions")):
            n = readers.set_aside(spark, path, schema, f"{args.out.rstrip('/')}/bad_lines/{name}")
            print(f"{name}: {n} lines cannot be read" + (f", see {args.out}/bad_lines/{name}" if n else ""))
    res = jobs.run_all(spark, raw_c, raw_t, args.out, snapshot=args.snapshot, tenure_date=args.tenure_date)
    summary = {
        "seconds": round(time.time() - t0, 1),
        "row_counts": res["etl"]["row_counts"],
        "quality_passed": res["etl"]["passed"],
        "best_k": res["segmentation"]["k"],
        "best_churn_model": res["churn"]["best"],
        "out": args.out,
    }
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main()
