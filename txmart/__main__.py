"""Command line: ``python -m txmart <command>``.

  run      --input PATH [PATH ...] --warehouse ROOT [--format csv] [--date-mode column|row]
  stream   --landing DIR --warehouse ROOT [--format csv] [--date-mode column|row]
  report   --warehouse ROOT --name NAME --output PATH   (A-1 .. A-7, written as Parquet)
  sql      --warehouse ROOT --query SQL --output PATH   (S-16; views are named layer_table)
  counts   --warehouse ROOT
  health   --warehouse ROOT

Uses the cluster's session settings (``spark-submit -m txmart ...`` or ``python -m``).
Reports and query results are written by the executors; only summaries, one line per table
or run, are printed as JSON.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from txmart.plans import job, reports
from txmart.settings import Settings
from txmart.sources.warehouse import Warehouse


def _reports(spark: SparkSession, root: str, as_of: dt.datetime) -> dict:
    t = lambda name: job.read_table(spark, root, name)
    moment = F.lit(as_of).cast("timestamp_ntz")
    return {
        "customer_summary": lambda: reports.customer_summary(t(job.CUST), t(job.FACT)),
        "product_performance": lambda: reports.product_performance(t(job.PROD), t(job.FACT)),
        "monthly_trend": lambda: reports.monthly_trend(t(job.FACT)),
        "quality_trend": lambda: reports.quality_trend(t(job.METRICS), moment),
        "run_performance": lambda: reports.run_performance(t(job.RUNLOG), moment),
        "recent_metrics": lambda: reports.recent_metrics(t(job.METRICS), moment),
        "latest_batch_report": lambda: reports.latest_batch_report(t(job.METRICS)),
    }


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="txmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("run", "stream", "report", "sql", "counts", "health"):
        p = sub.add_parser(name)
        p.add_argument("--warehouse", required=True)
        if name in ("run", "stream"):
            p.add_argument("--input" if name == "run" else "--landing", required=True, nargs="+" if name == "run" else None)
            p.add_argument("--format", default=None if name == "run" else "csv")
            p.add_argument("--date-mode", default="column", choices=["column", "row"])
        if name == "report":
            p.add_argument("--name", required=True, choices=["customer_summary", "product_performance", "monthly_trend", "quality_trend", "run_performance", "recent_metrics", "latest_batch_report"])
            p.add_argument("--as-of", type=dt.datetime.fromisoformat, default=None)
        if name == "sql":
            p.add_argument("--query", required=True)
        if name in ("report", "sql"):
            p.add_argument("--output", required=True)
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName("txmart").getOrCreate()
    if a.cmd == "run":
        summary = job.run(spark, a.input, a.warehouse, Settings(date_mode=a.date_mode), fmt=a.format)
        print(json.dumps(summary.as_dict(), default=str))
    elif a.cmd == "stream":
        from txmart.streaming import incremental

        summary = incremental.run_available(spark, a.landing, a.warehouse, settings=Settings(date_mode=a.date_mode), fmt=a.format)
        print(json.dumps(summary.as_dict() if summary else {"pending": 0}, default=str))
    elif a.cmd == "report":
        _reports(spark, a.warehouse, a.as_of or dt.datetime.now())[a.name]().write.mode("overwrite").parquet(a.output)
    elif a.cmd == "sql":
        Warehouse(spark, a.warehouse).sql(a.query).write.mode("overwrite").parquet(a.output)
    elif a.cmd == "counts":
        for row in job.table_counts(spark, a.warehouse).collect():
            print(json.dumps(row.asDict()))
    else:
        healthy = Warehouse(spark, a.warehouse).health_check()
        print(json.dumps({"healthy": healthy}))
        return 0 if healthy else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
