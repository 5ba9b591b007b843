"""Headline timings: prints one JSON line.

The insurance-shaped inputs are derived from the tables of $BENCH_SF_DIR and written as
parquet first (reported as ``setup``, not part of the value). Every timed query starts
from those files and runs to completion.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from dataclasses import replace

from pyspark.sql import SparkSession

from rateloom.operators import losses as loss_ops
from rateloom.plans.report import pricing_report
from rateloom.plans.summary import pricing_summary, stat_table
from rateloom.sources.sinks import snapshot
from rateloom.sources.store import shared_folder
from verification.catalog import REPORT_PARAMS, REPORT_PLAN, Inputs
from verification.fixtures import EXTRACT_FLOOR, FIXTURE_PARAMS, stored_fixtures

P = FIXTURE_PARAMS


def report(inputs: Inputs):
    plan = replace(REPORT_PLAN, accept_growth=True)
    return pricing_report(inputs.sources, REPORT_PARAMS, plan, history_start=EXTRACT_FLOOR)[1]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = os.environ.get("BENCH_WORK_DIR") or f"{shared_folder(spark)}/bench-{uuid.uuid4().hex}"
    started = time.time()
    inputs = Inputs(spark, sf_dir, stored_fixtures(spark, sf_dir, work))
    base = snapshot(inputs.base, f"{work}/base")
    quotes = snapshot(inputs.quotes, f"{work}/quotes")
    setup = time.time() - started

    runs = {
        "pricing_summary": lambda: pricing_summary(base, quotes, P),
        "pricing_summary_warm": lambda: pricing_summary(base, quotes, P),
        "summary_from_extracts": lambda: pricing_summary(inputs.base, quotes, P),
        "pricing_report": lambda: report(inputs),
        "premium_extract": lambda: inputs.source_premium,
        "quote_extract": lambda: inputs.source_quotes,
        "loss_pivot": lambda: loss_ops.loss_by_vehicle(inputs.losses_cut),
        "premium_loss_base": lambda: inputs.base,
        "sales_stats": lambda: stat_table(base, None, P, ["PCVS_QB", "WVS_QB", "AVS_QB", "TVS_PB"]),
        "premium_loss_sums": lambda: stat_table(base, None, P, ["EE", "EP", "CLEP", "LOSS_CC", "LOSS_25", "LOSS_100", "LOSS_RI"]),
        "quote_stats": lambda: stat_table(None, quotes, P, ["PCVQ_QB", "WVQ_QB", "AVQ_QB", "TPQ_QB"]),
    }
    seconds = {}
    for name, build in runs.items():
        started = time.time()
        build().write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    found = re.search(r"sf([0-9.]+)/?$", sf_dir)
    print(json.dumps({
        "metric": "seconds over all headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(found.group(1)) if found else None, "setup": round(setup, 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
