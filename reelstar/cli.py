"""Command-line jobs: ``python -m reelstar <command> ...``.

* ``transform`` — raw landed history -> the three curated tables (+ catalog);
  with ``--incremental --runs GLOB`` only the new runs are merged into the
  date-partitioned dedup store before the tables are rebuilt from it.
* ``land`` — one landing run from a source table of events (Parquet or JSON
  lines) against the versioned state: data, manifest, then checkpoint.
* ``validate`` — the validation/analytics SQL and the quality report over
  the registered curated tables; ``--fail-on-quality`` makes a failed gate
  fail the job.
* ``profile`` — field/type profile of raw JSON records, whatever the layout
  of their files (lines, array pages, pretty-printed documents).

Reports are printed as JSON lines, at most ``--limit`` rows each (a preview
taken with ``limit``; nothing unbounded is collected to the driver). Full
results stay distributed: the manifest is written in the run directory, and
``validate --out PATH`` writes each query's answer as Parquet.
"""

from __future__ import annotations

import argparse
import json
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar import schemas
from reelstar.functions.columns import DEFAULT_CHANNEL_RULES
from reelstar.operators import profile as pf
from reelstar.operators import quality as dq
from reelstar.plans import analytics as an
from reelstar.plans import incremental, pipeline
from reelstar.session import build_session
from reelstar.sources import raw
from reelstar.sources.json_layout import scan_records


def _rules(values: list[str] | None):
    if not values:
        return DEFAULT_CHANNEL_RULES
    out = []
    for v in values:
        needle, _, label = v.partition("=")
        out.append((needle, label))
    return tuple(out)


def _print_rows(df, limit: int = 100) -> None:
    for r in df.limit(limit).collect():
        print(json.dumps(r.asDict(recursive=True), default=str))


def cmd_transform(spark: SparkSession, a: argparse.Namespace) -> int:
    runs = a.runs if a.incremental else raw.ALL_RUNS
    scans = {
        "events": raw.scan_events(spark, a.raw, runs=runs, allow_missing=a.incremental, keep_corrupt=True),
        "media_metadata": raw.scan_metadata(spark, a.raw, allow_missing=True, keep_corrupt=True),
        "media_stats": raw.scan_stats(spark, a.raw, allow_missing=True, keep_corrupt=True),
    }
    if a.quarantine:
        aside = [raw.split_corrupt(found)[1].select(F.lit(kind).alias("kind"), "*") for kind, found in scans.items()]
        reduce(DataFrame.unionByName, aside).write.mode("overwrite").json(a.quarantine)
    # Counted while the transform reads them, not by a pass of their own.
    watched = {kind: raw.counted(found, kind) for kind, found in scans.items()}
    good = {kind: raw.split_corrupt(found)[0] for kind, (found, _) in watched.items()}
    build = incremental.run_incremental_transform if a.incremental else pipeline.run_transform
    counts = build(
        spark, good["events"], good["media_metadata"], good["media_stats"], a.curated, channel_rules=_rules(a.channel_rule), db=a.db
    )
    malformed = {kind: n for kind, (_, totals) in watched.items() if (n := totals.get["malformed"])}
    name = "quarantined_records" if a.quarantine else "malformed_records"
    counts[name] = sum(malformed.values())
    counts[f"{name}_by_kind"] = malformed
    print(json.dumps(counts))
    return 0


def cmd_land(spark: SparkSession, a: argparse.Namespace) -> int:
    reader = spark.read.schema(schemas.RAW_EVENT)
    source = reader.parquet(a.source) if a.source_format == "parquet" else reader.json(a.source)
    media = a.media.split(",") if a.media else None
    manifest = pipeline.run_landing(
        spark, source, media, a.state, a.raw, run_id=a.run_id, run_date=a.run_date, lookback_seconds=a.lookback_seconds
    )
    _print_rows(manifest.orderBy("media_id"), a.limit)
    return 0


def cmd_validate(spark: SparkSession, a: argparse.Namespace) -> int:
    for name, sql in an.SQL.items():
        result = spark.sql(sql.format(db=a.db))
        if a.out:
            result.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/{name}")
        print(json.dumps({"query": name}))
        _print_rows(result, a.limit)
    fact = spark.table(f"{a.db}.fact_media_engagement")
    report = dq.quality_report(fact, spark.table(f"{a.db}.dim_media"), spark.table(f"{a.db}.dim_visitor"))
    row = report.first().asDict()
    print(json.dumps({"quality": row}))
    if a.fail_on_quality and not row["passed"]:
        return 2
    return 0


def cmd_profile(spark: SparkSession, a: argparse.Namespace) -> int:
    # Any layout: the records of lines, array pages and documents alike.
    records = scan_records(spark, a.path).select(F.col("record").alias("json"))
    reports = {"fields": pf.field_profile(spark, records)}
    if a.nested:
        reports["nested"] = pf.nested_profile(spark, records)
    for name, report in reports.items():
        if a.out:
            report.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/{name}")
        _print_rows(report.orderBy("field", "json_type"), a.limit)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="reelstar")
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=None)
    p.add_argument("--limit", type=int, default=100, help="rows printed per report (a preview)")
    sub = p.add_subparsers(dest="command", required=True)

    t = sub.add_parser("transform")
    t.add_argument("--raw", required=True)
    t.add_argument("--curated", required=True)
    t.add_argument("--db", default=None)
    t.add_argument("--channel-rule", action="append", help="needle=Label, in priority order")
    t.add_argument("--quarantine", default=None, help="write malformed event records here (JSON) instead of transforming them")
    t.add_argument("--incremental", action="store_true", help="merge only --runs into the dedup store, then rebuild")
    t.add_argument("--runs", default=raw.ALL_RUNS, help="run glob for --incremental, e.g. 'run_date=2024-02-01/run_id=*'")
    t.set_defaults(run=cmd_transform)

    ld = sub.add_parser("land")
    ld.add_argument("--source", required=True)
    ld.add_argument("--source-format", choices=("parquet", "json"), default="parquet")
    ld.add_argument("--state", required=True)
    ld.add_argument("--raw", required=True)
    ld.add_argument("--run-id", required=True)
    ld.add_argument("--run-date", required=True)
    ld.add_argument("--media", default=None, help="comma-separated allow-list")
    ld.add_argument("--lookback-seconds", type=int, default=0)
    ld.set_defaults(run=cmd_land)

    v = sub.add_parser("validate")
    v.add_argument("--db", required=True)
    v.add_argument("--fail-on-quality", action="store_true")
    v.add_argument("--out", default=None, help="write every query's full answer as Parquet under this path")
    v.set_defaults(run=cmd_validate)

    pr = sub.add_parser("profile")
    pr.add_argument("--path", required=True)
    pr.add_argument("--nested", action="store_true")
    pr.add_argument("--out", default=None, help="write the full profiles as Parquet under this path")
    pr.set_defaults(run=cmd_profile)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or build_session(a.master, shuffle_partitions=a.shuffle_partitions)
    return a.run(spark, a)


if __name__ == "__main__":
    sys.exit(main())
