"""Incremental transform == full rebuild."""

from __future__ import annotations

import os
import shutil

from pyspark.sql import Row
from pyspark.sql import functions as F

from reelstar import schemas
from reelstar.plans import incremental as inc
from reelstar.plans import pipeline
from reelstar.plans import star as st
from reelstar.sources import fixtures as fx
from reelstar.sources import raw
from reelstar.sinks import landing as land
from reelstar.sinks.key_index import DAY, KEY, KeyIndex
from reelstar.streaming import landing as stream

SF = "/root/testdata/sf0.001"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _tables(spark, root):
    return {n: raw.read_curated(spark, root, n) for n in ("dim_media", "dim_visitor", "fact_media_engagement")}


def test_incremental_runs_equal_full_rebuild(spark, tmp_path):
    ev = fx.raw_events(spark, SF)
    run1 = ev.where(F.col("_source_file").contains(fx.RUN1_ID))
    run2 = ev.where(F.col("_source_file").contains(fx.RUN2_ID))
    meta, stats = fx.raw_metadata(spark, SF), fx.raw_stats(spark, SF)
    rules = fx.channel_rules()

    full = str(tmp_path / "full")
    pipeline.run_transform(spark, ev, meta, stats, full, channel_rules=rules)

    inc_root = str(tmp_path / "inc")
    inc.run_incremental_transform(spark, run1, meta, stats, inc_root, channel_rules=rules)
    counts = inc.run_incremental_transform(spark, run2, meta, stats, inc_root, channel_rules=rules)
    assert counts["fact_media_engagement"] == 1000
    a, b = _tables(spark, full), _tables(spark, inc_root)
    for name in a:
        assert _same(a[name], b[name]), name
    # replaying a run changes nothing
    inc.run_incremental_transform(spark, run2, meta, stats, inc_root, channel_rules=rules)
    assert _same(_tables(spark, inc_root)["fact_media_engagement"], a["fact_media_engagement"])


def test_redelivered_copy_moves_its_day(spark, tmp_path):
    def row(key, at, url, run):
        r = {f.name: None for f in schemas.RAW_EVENT.fields}
        r.update(event_key=key, media_id="m1", received_at=at, media_url=url)
        return Row(**r), f"raw/run_date=x/run_id={run}/events/media_id=m1/p.json"

    def frame(rows):
        parts = [spark.createDataFrame([r], schemas.RAW_EVENT).withColumn("_source_file", F.lit(p)) for r, p in rows]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    store = str(tmp_path / "store")
    first = frame([row("k", "2026-01-01T10:00:00.000Z", "old", "20260101T000000Z"), row("j", "2026-01-02T10:00:00.000Z", "j", "20260101T000000Z")])
    inc.merge_new_events(spark, first, store)
    assert {"date=2026-01-01", "date=2026-01-02"} <= set(os.listdir(store))
    second = frame([row("k", "2026-01-03T10:00:00.000Z", "new", "20260103T000000Z")])
    res = inc.merge_new_events(spark, second, store)
    assert res["emptied_dates"] == 1  # k left 2026-01-01, which had no other rows
    got = {r.event_key: (r.media_url, str(r.date)) for r in inc.read_store(spark, store).collect()}
    assert got == {"k": ("new", "2026-01-03"), "j": ("j", "2026-01-02")}
    assert not os.path.exists(os.path.join(store, "date=2026-01-01"))
    # the same answer as one full dedup over both runs
    full = {r.event_key: r.media_url for r in st.dedup_events(first.unionByName(second)).collect()}
    assert full == {"k": "new", "j": "j"}


def test_key_lookup_does_not_move_the_stored_keys(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "keys"), buckets=4)
    day = F.lit("2024-01-01").cast("date")
    index.add(spark.range(2000).select(F.concat(F.lit("=k"), F.col("id").cast("string")).alias(KEY), day.alias(DAY)))
    index.add(spark.range(1000, 3000).select(F.concat(F.lit("=k"), F.col("id").cast("string")).alias(KEY), day.alias(DAY)))
    assert index.table().count() == 3000  # a pair is added once
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = spark.range(2990, 3010).select(F.concat(F.lit("=k"), F.col("id").cast("string")).alias(KEY))
        found = index.known(keys)
        plan = found._jdf.queryExecution().executedPlan().toString()
        stored = plan[plan.index("SortMergeJoin") : plan.index("FileScan")]  # from the join down to the stored keys
        assert "SelectedBucketsCount: 4 out of 4" in plan and "Exchange" not in stored, plan
        assert found.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # another session knows the index by its path alone, with the buckets it was made with
    spark.sql(f"DROP TABLE {index.name}")
    assert KeyIndex(spark, str(tmp_path / "keys"), buckets=9).table().count() == 3000


def test_a_store_without_an_index_gets_one(spark, tmp_path):
    ev = fx.raw_events(spark, SF)
    inc.merge_new_events(spark, ev.where(F.col("_source_file").contains(fx.RUN1_ID)), str(tmp_path / "first"))
    store = str(tmp_path / "store")
    shutil.copytree(tmp_path / "first", store)  # the events alone
    inc.merge_new_events(spark, ev.where(F.col("_source_file").contains(fx.RUN2_ID)), store)
    assert inc.read_store(spark, store).count() == st.dedup_events(ev).count() == 1000


def test_stream_with_a_key_index_is_exact_however_late(spark, tmp_path):
    raw_root, out, ckpt, keys = (str(tmp_path / n) for n in ("raw", "out", "ckpt", "keys"))
    base = {f.name: None for f in schemas.RAW_EVENT.fields}

    def deliver(run, *records):
        rows = [Row(**{**base, "event_key": k, "media_id": "m", "received_at": f"2026-01-{d:02d}T00:00:00.000Z"}) for k, d in records]
        land.land_events(spark.createDataFrame(rows, schemas.RAW_EVENT), raw_root, f"202602{run:02d}T000000Z", f"2026-02-{run:02d}")
        stream.start_landing_stream(spark, raw_root, out, ckpt, key_index=keys).awaitTermination()
        return sorted(r.event_key or "-" for r in spark.read.parquet(out).collect())

    assert deliver(1, ("a", 1), ("a", 1), ("b", 2), (None, 2)) == ["-", "a", "b"]
    assert deliver(2, ("c", 20)) == ["-", "a", "b", "c"]
    assert deliver(3, ("a", 1), ("b", 12), (None, 1)) == ["-", "a", "b", "c"]  # copies, up to 19 days late
    assert deliver(4, ("late", 3)) == ["-", "a", "b", "c", "late"]  # a first delivery, 17 days late
    # a replay of a batch writes the same rows: its own keys do not count against it
    index = KeyIndex(spark, keys)
    rows = spark.createDataFrame([("=a",), ("=late",), ("=x",)], f"{KEY} string")
    assert sorted(r[0] for r in index.unknown(rows, other_than="3").collect()) == ["=late", "=x"]
    assert sorted(r[0] for r in index.unknown(rows, other_than="9").collect()) == ["=x"]
