"""Command line: the jobs and reports as subcommands.

    python -m tidemark ingest   --raw R --cleansed C --checkpoints K [--bucket order_items=4096]
    python -m tidemark build    --cleansed C --curated U --run-ts TS [--as-of TS] [--run-log L]
    python -m tidemark quality  --curated U [--min-rows N --max-price P --min-delivered R]
    python -m tidemark metrics  --curated U [--now TS]
    python -m tidemark profile  --dir D
    python -m tidemark pii      --curated U --out O

Each prints its result table; ``--json`` prints JSON lines instead.  On a
cluster the session comes from ``spark-submit``; locally one is created.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame


def _show(df: DataFrame, as_json: bool) -> None:
    if as_json:
        for row in df.toJSON().collect():   # result tables only: a row per rule / metric / table
            print(row)
    else:
        df.show(200, truncate=False)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("--json", action="store_true")
    sub = p.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest")
    ing.add_argument("--raw", required=True)
    ing.add_argument("--cleansed", required=True)
    ing.add_argument("--checkpoints", required=True)
    ing.add_argument("--bucket", action="append", default=[], help="table=buckets")
    bld = sub.add_parser("build")
    bld.add_argument("--cleansed", required=True)
    bld.add_argument("--curated", required=True)
    bld.add_argument("--run-ts", required=True)
    bld.add_argument("--as-of")
    bld.add_argument("--run-log")
    bld.add_argument("--incremental", action="store_true", help="rebuild only orders affected since the published build")
    qa = sub.add_parser("quality")
    qa.add_argument("--curated", required=True)
    qa.add_argument("--min-rows", type=int, default=100000)
    qa.add_argument("--max-price", type=float, default=7000)
    qa.add_argument("--min-delivered", type=float, default=0.90)
    met = sub.add_parser("metrics")
    met.add_argument("--curated", required=True)
    met.add_argument("--now", default=None)
    prof = sub.add_parser("profile")
    prof.add_argument("--dir", required=True)
    pii = sub.add_parser("pii")
    pii.add_argument("--curated", required=True)
    pii.add_argument("--out", required=True)
    a = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from tidemark.session import apply_core_conf, build_session
    spark = SparkSession.getActiveSession() or build_session()
    apply_core_conf(spark)

    from tidemark.plans import jobs as J
    if a.cmd == "ingest":
        buckets = {k: int(v) for k, v in (b.split("=", 1) for b in a.bucket)}
        done = J.raw_to_cleansed(spark, a.raw, a.cleansed, a.checkpoints, buckets=buckets)
        _show(spark.createDataFrame(sorted(done.items()), "table_name string, versions long"), a.json)
    elif a.cmd == "build":
        run_log = a.run_log or f"{a.curated.rstrip('/')}/_runs"     # read back by `metrics`
        row = J.daily_pipeline(spark, a.cleansed, a.curated, a.run_ts, a.as_of or a.run_ts, run_log=run_log,
                               incremental=a.incremental)
        _show(row, a.json)
        return 0 if row.first()["outcome"] == "ok" else 2
    elif a.cmd == "quality":
        from tidemark.operators import quality as Q
        t = J.read_curated(spark, a.curated)
        rules = Q.fact_ruleset(a.min_rows, a.max_price, min_delivered=a.min_delivered)
        res = Q.evaluate(spark, t["fact_order_item"], rules)
        _show(res.orderBy("rule_index"), a.json)
        _show(Q.score(res), a.json)
    elif a.cmd == "metrics":
        import datetime as dt

        from tidemark.plans import metrics as M
        t = J.read_curated(spark, a.curated)
        now = a.now or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        dims = {k: v for k, v in t.items() if k != "fact_order_item"}
        from tidemark.sources.tables import exists
        runs = f"{a.curated.rstrip('/')}/_runs"
        run_log = spark.read.parquet(runs).where("outcome = 'ok'") if exists(spark, runs) else None
        _show(M.all_metrics(spark, t["fact_order_item"], dims, t["dim_customer"], now, run_log=run_log,
                            zone=a.curated), a.json)
    elif a.cmd == "profile":
        from tidemark.operators.profile import profile_dir
        _show(profile_dir(spark, a.dir), a.json)
    elif a.cmd == "pii":
        from tidemark.operators import govern as G
        from tidemark.sources.files import write_csv
        t = J.read_curated(spark, a.curated)
        people = G.synth_pii(G.current_customers(t["dim_customer"]))
        write_csv(people, a.out)
        _show(spark.read.schema(people.schema).option("header", True).csv(a.out)
              .groupBy("province").count().orderBy("province"), a.json)
    return 0


if __name__ == "__main__":
    sys.exit(main())
