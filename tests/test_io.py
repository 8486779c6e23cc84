"""Sources and sinks on a real file layout: raw JSON runs, curated Parquet,
catalog tables, versioned landing state, replay, and the streaming form."""

from __future__ import annotations

import json
import os

from pyspark.sql import Row
from pyspark.sql import functions as F

from reelstar import schemas
from reelstar.plans import analytics as an
from reelstar.plans import pipeline
from reelstar.plans import star as st
from reelstar.sinks import landing as land
from reelstar.sources import fixtures as fx
from reelstar.operators.landing import plan_landing
from reelstar.sources import raw
from reelstar.sources.event_source import DatedSource
from reelstar.sources.json_layout import parsed, records_of_text, split_corrupt
from reelstar.streaming import landing as stream

SF = "/root/testdata/sf0.001"


def _write_page(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        json.dump(records, fh, indent=2)


def test_array_pages_two_runs_by_glob(spark, tmp_path):
    # Pages as JSON arrays, the reference's landed form, in two runs.
    root = tmp_path / "raw"
    for run_date, run_id, key in [("2026-08-15", "20260815T060000Z", "a"), ("2026-08-16", "20260816T060000Z", "b")]:
        base = root / f"run_date={run_date}" / f"run_id={run_id}"
        _write_page(str(base / "events" / "media_id=m1" / "page_001.json"), [{"event_key": key, "media_id": "m1", "received_at": "2026-08-15T07:51:28.000Z", "percent_viewed": 1}])
        _write_page(str(base / "media_metadata.json"), [{"hashed_id": "m1", "name": "T", "updated": run_date + "T00:00:00.000Z", "duration": 10}])
        _write_page(str(base / "media_stats" / "m1.json"), {"play_rate": 0.5})
    ev = raw.with_run(raw.scan_events(spark, str(root)))
    rows = sorted((r.event_key, r.run_id, r.percent_viewed) for r in ev.collect())
    assert rows == [("a", "20260815T060000Z", 1.0), ("b", "20260816T060000Z", 1.0)]  # whole numbers stay double
    assert ev.schema["user_agent_details"].dataType == schemas.USER_AGENT  # absent everywhere, still typed
    assert ev.where(F.col("user_agent_details").isNotNull()).count() == 0
    stats = st.latest_stats(raw.scan_stats(spark, str(root))).collect()
    assert [(r.media_id, r.run_id) for r in stats] == [("m1", "20260816T060000Z")]
    meta = raw.scan_metadata(spark, str(root))
    assert meta.count() == 2


_ROWS = [{"event_key": f"k{i}", "media_id": "m1", "received_at": f"2026-08-15T07:51:{i:02d}.000Z", "percent_viewed": i / 8, "user_agent_details": {"browser": "{b,\n[", "mobile": i % 2 == 0}} for i in range(5)]
_LAYOUTS = {
    "lines": "\n".join(json.dumps(r) for r in _ROWS) + "\n",
    "crlf_lines": "\r\n".join(json.dumps(r) for r in _ROWS) + "\r\n\r\n",
    "page": json.dumps(_ROWS),
    "pretty_page": json.dumps(_ROWS, indent=2),
    "tabbed_page": json.dumps(_ROWS, indent="\t") + "\n",
    "record_a_line": "[\n" + ",\n".join(json.dumps(r) for r in _ROWS) + "\n]\n",
    "pages_by_line": json.dumps(_ROWS[:2]) + "\n" + json.dumps(_ROWS[2:]) + "\n",
    "hugging": "[" + ", ".join(json.dumps(r, indent=1) for r in _ROWS) + "]",
    "indented_lines": "\n".join("  " + json.dumps(r) for r in _ROWS),
    "bom_page": "\ufeff" + json.dumps(_ROWS, indent=2),
    "empty": "",
    "empty_page": "[]\n",
    "empty_pretty_page": "[\n\n]\n",
}


def _write_layouts(root):
    for name, text in _LAYOUTS.items():
        path = root / "run_date=2026-08-15" / "run_id=20260815T060000Z" / "events" / f"media_id={name}" / "page_001.json"
        path.parent.mkdir(parents=True)
        path.write_text(text, newline="")


def _by_file(rows):
    found = {name: [] for name in _LAYOUTS}
    for r in rows:
        found[r._source_file.split("media_id=")[1].split("/")[0]].append(r)
    return found


def test_every_layout_of_one_tree_gives_the_same_records(spark, tmp_path):
    _write_layouts(tmp_path / "raw")
    expected = [(r["event_key"], r["percent_viewed"], r["user_agent_details"]["browser"]) for r in _ROWS]

    def check(rows):
        for name, found in _by_file(rows).items():
            got = sorted((r.event_key, r.percent_viewed, r.user_agent_details.browser) for r in found)
            assert got == ([] if name.startswith("empty") else expected), name

    check(raw.scan_events(spark, str(tmp_path / "raw")).collect())
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")  # files cut between and within records
    try:
        check(raw.scan_events(spark, str(tmp_path / "raw")).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    out = str(tmp_path / "out")
    query = stream.read_event_stream(spark, str(tmp_path / "raw")).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    query.trigger(availableNow=True).start(out).awaitTermination()
    check(spark.read.parquet(out).collect())


def test_malformed_records_of_every_layout_are_kept_aside(spark, tmp_path):
    good, one, two = (json.dumps(r) for r in _ROWS[:3])
    cases = {
        "cut_line": (f"{good}\n{one[:30]}\n{two}\n", 2, 1),
        "two_cut_lines": (f"{one[:30]}\n{good}\n{two[:9]}\n", 1, 2),
        "cut_pretty_page": (json.dumps(_ROWS, indent=2)[:-40], 0, 1),
        "cut_page": (json.dumps(_ROWS)[:-4], 0, 1),
        "wrong_type": ('{"event_key": "a", "percent_viewed": "much"}\n' + good, 1, 1),
        "no_objects": ('[1, null, "x"]\n' + good, 1, 3),
    }
    for name, (text, _, _) in cases.items():
        path = tmp_path / "raw" / "run_date=2026-08-15" / "run_id=20260815T060000Z" / "events" / f"media_id={name}" / "page_001.json"
        path.parent.mkdir(parents=True)
        path.write_text(text)
    found = raw.scan_events(spark, str(tmp_path / "raw"), keep_corrupt=True)
    watched, totals = raw.counted(found, "events")
    rows = watched.collect()
    for name, (_, well, ill) in cases.items():
        own = [r for r in rows if f"media_id={name}/" in r._source_file]
        assert (sum(r._corrupt_record is None for r in own), sum(r._corrupt_record is not None for r in own)) == (well, ill), name
    assert totals.get == {"records": sum(a + b for _, a, b in cases.values()), "malformed": sum(b for _, _, b in cases.values())}
    events, corrupt = raw.split_corrupt(found)
    assert events.count() == sum(a for _, a, _ in cases.values()) and corrupt.count() == sum(b for _, _, b in cases.values())
    assert events.where("event_key is null").count() == 0


def test_malformed_snapshots_do_not_reach_the_star(spark, tmp_path):
    root = tmp_path / "raw"
    for run_date, run_id, meta, stats in [
        ("2026-08-15", "20260815T060000Z", json.dumps([{"hashed_id": "m1", "name": "T", "updated": "2026-08-15T00:00:00.000Z", "duration": 10}], indent=2), '{\n  "play_rate": 0.5\n}'),
        ("2026-08-16", "20260816T060000Z", '[\n  {\n    "hashed_id": "m1", "na', '{\n  "play_rate": 0.'),
    ]:
        base = root / f"run_date={run_date}" / f"run_id={run_id}"
        (base / "media_stats").mkdir(parents=True)
        (base / "media_metadata.json").write_text(meta)
        (base / "media_stats" / "m1.json").write_text(stats)
        _write_page(str(base / "events" / "media_id=m1" / "page_001.json"), [{"event_key": run_date, "media_id": "m1", "received_at": f"{run_date}T07:51:28.000Z", "percent_viewed": 0.5}])
    star = st.build_star(raw.scan_events(spark, str(root)), raw.scan_metadata(spark, str(root)), raw.scan_stats(spark, str(root)))
    assert [(r.media_id, r.title) for r in star.dim_media.collect()] == [("m1", "T")]
    assert [(r.play_rate, r.total_watch_time) for r in star.fact.collect()] == [(0.5, 5.0)] * 2
    aside = [raw.split_corrupt(scan(spark, str(root), keep_corrupt=True))[1].count() for scan in (raw.scan_metadata, raw.scan_stats, raw.scan_events)]
    assert aside == [1, 1, 0]


def test_empty_glob_gives_empty_frame(spark, tmp_path):
    df = raw.scan_events(spark, str(tmp_path / "nothing"), allow_missing=True)
    assert df.count() == 0 and "event_key" in df.columns


def test_landing_runs_state_and_transform(spark, tmp_path):
    raw_root, state_root, curated = str(tmp_path / "raw"), str(tmp_path / "state"), str(tmp_path / "curated")
    media = fx.configured_media(spark, SF)
    source = fx.source_events(spark, SF).join(media, "media_id", "left_semi")  # media outside the catalog never land
    early = source.where(F.col("received_at") < "2024-01-20")

    store = land.StateStore(spark, state_root)
    assert store.read().count() == 0  # first run: no checkpoint

    m1 = pipeline.run_landing(spark, early, media, state_root, raw_root, run_id="20240120T060000Z", run_date="2024-01-20",
                              metadata=fx.raw_metadata(spark, SF).drop("_source_file"),
                              stats=fx.raw_stats(spark, SF).withColumn("media_id", raw.stats_media_id("_source_file")).drop("_source_file"))
    assert {r.mode for r in m1.collect()} == {"full"}
    first_saved = early.count()
    assert m1.agg(F.sum("events_saved")).first()[0] == first_saved

    m2 = pipeline.run_landing(spark, source, media, state_root, raw_root, run_id="20240131T060000Z", run_date="2024-01-31")
    modes = {r.mode for r in m2.where(F.col("events_fetched") > 0).collect()}
    assert "incremental" in modes
    total = source.count()
    # strict '>' against per-media marks: nothing is landed twice, nothing lost here
    assert m2.agg(F.sum("events_saved")).first()[0] == total - first_saved
    assert store.read().count() == m2.where("checkpoint_after is not null").count()

    landed = raw.scan_events(spark, raw_root)
    assert landed.count() == total

    counts = pipeline.run_transform(spark, landed, raw.scan_metadata(spark, raw_root), raw.scan_stats(spark, raw_root), curated, db="reelstar_test")
    assert counts["fact_media_engagement"] == counts["unique_events"] == total
    assert any(p.startswith("date=") for p in os.listdir(os.path.join(curated, "fact_media_engagement")))

    # Catalog SQL == DataFrame form over the same tables.
    fact = raw.read_curated(spark, curated, "fact_media_engagement")
    dim = raw.read_curated(spark, curated, "dim_media")
    sql = {tuple(r) for r in spark.sql(an.SQL["sql_watch_minutes"].format(db="reelstar_test")).collect()}
    df = {tuple(r) for r in an.watch_minutes(fact, dim).collect()}
    assert sql == df and len(sql) > 0
    assert spark.sql(an.SQL["sql_counts_one_row"].format(db="reelstar_test")).first().engagement_count == total

    # Replay (at-least-once): re-land run 2 under a new run id; the fact is unchanged.
    replay = source.where(F.col("received_at") >= "2024-01-20")
    land.land_events(replay, raw_root, "20240201T060000Z", "2024-02-01")
    again = str(tmp_path / "curated2")
    counts2 = pipeline.run_transform(spark, raw.scan_events(spark, raw_root), raw.scan_metadata(spark, raw_root), raw.scan_stats(spark, raw_root), again)
    assert counts2["raw_events"] > counts["raw_events"]
    assert counts2["fact_media_engagement"] == counts["fact_media_engagement"]
    a = raw.read_curated(spark, curated, "fact_media_engagement").drop("date")
    b = raw.read_curated(spark, again, "fact_media_engagement").drop("date")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_state_store_versions(spark, tmp_path):
    store = land.StateStore(spark, str(tmp_path / "state"))
    v1 = spark.createDataFrame([Row(media_id="a", last_received_at="1")], schemas.STATE)
    v2 = spark.createDataFrame([Row(media_id="a", last_received_at="2"), Row(media_id="b", last_received_at="2")], schemas.STATE)
    store.write(v1, "20260101T000000Z")
    assert [tuple(r) for r in store.read().collect()] == [("a", "1")]
    store.write(v2, "20260102T000000Z")
    assert sorted(tuple(r) for r in store.read().collect()) == [("a", "2"), ("b", "2")]
    try:
        store.write(v1, "20260102T000000Z")
        raise AssertionError("overwrote a published version")
    except Exception as exc:  # noqa: BLE001
        assert "already exists" in str(exc).lower() or "PATH_ALREADY_EXISTS" in str(exc)


def test_stream_landing_available_now_is_idempotent(spark, tmp_path):
    raw_root = str(tmp_path / "raw")
    src = fx.source_events(spark, SF)
    land.land_events(src.where(F.col("received_at") < "2024-01-20"), raw_root, "20240120T060000Z", "2024-01-20")
    land.land_events(src.where(F.col("received_at") >= "2024-01-15"), raw_root, "20240131T060000Z", "2024-01-31")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = stream.start_landing_stream(spark, raw_root, out, ckpt, watermark="30 days")
    q.awaitTermination()
    first = spark.read.parquet(out).count()
    q = stream.start_landing_stream(spark, raw_root, out, ckpt, watermark="30 days")
    q.awaitTermination()
    assert spark.read.parquet(out).count() == first  # rerun over the same files adds nothing
    # stream dedup == batch dedup (all copies lie within the watermark horizon)
    batch = st.dedup_events(raw.scan_events(spark, raw_root)).count()
    assert first == batch == src.count()


def test_failed_run_records_manifest_and_keeps_marks(spark, tmp_path):
    raw_root, state_root = str(tmp_path / "raw"), str(tmp_path / "state")
    store = land.StateStore(spark, state_root)
    store.write(spark.createDataFrame([Row(media_id="m1", last_received_at="2024-01-01T00:00:00.000Z")], schemas.STATE), "20240101T000000Z")
    bad = spark.createDataFrame([Row(**{**{f.name: None for f in schemas.RAW_EVENT.fields}, "media_id": "m1", "received_at": "2024-02-01T00:00:00.000Z"})], schemas.RAW_EVENT)
    bad = bad.withColumn("event_key", F.raise_error(F.lit("source unavailable")))  # fails when the run executes
    try:
        pipeline.run_landing(spark, bad, ["m1", "m2"], state_root, raw_root, run_id="20240202T000000Z", run_date="2024-02-02")
        raise AssertionError("run should have failed")
    except Exception as exc:  # noqa: BLE001
        assert "source unavailable" in str(exc)
    man = spark.read.schema(schemas.MANIFEST).json(f"{raw_root}/run_date=2024-02-02/run_id=20240202T000000Z/run_manifest.json")
    rows = {r.media_id: r for r in man.collect()}
    assert set(rows) == {"m1", "m2"} and {r.status for r in rows.values()} == {"failed"}
    assert "source unavailable" in rows["m1"].error
    assert [tuple(r) for r in store.read().collect()] == [("m1", "2024-01-01T00:00:00.000Z")]  # marks unchanged


def test_legacy_checkpoint_and_manifest_documents(spark, tmp_path):
    ck = tmp_path / "state" / "checkpoint.json"
    ck.parent.mkdir(parents=True)
    ck.write_text(json.dumps({"m1": {"last_received_at": "2026-08-15T07:51:28.000Z"}, "m2": {"last_received_at": "2026-08-16T00:00:00.000Z"}}, indent=2))
    got = sorted(tuple(r) for r in raw.read_legacy_checkpoint(spark, str(ck)).collect())
    assert got == [("m1", "2026-08-15T07:51:28.000Z"), ("m2", "2026-08-16T00:00:00.000Z")]
    assert raw.read_legacy_checkpoint(spark, str(tmp_path / "missing.json")).count() == 0
    run = tmp_path / "raw" / "run_date=2026-08-16" / "run_id=20260816T060000Z"
    run.mkdir(parents=True)
    (run / "run_manifest.json").write_text(json.dumps({
        "run_id": "20260816T060000Z", "run_date": "2026-08-16", "status": "success", "media_ids": ["m1"],
        "media": {"m1": {"mode": "incremental", "checkpoint_before": "a", "checkpoint_after": "b", "pages_fetched": 1, "events_fetched": 2, "events_saved": 1}},
    }, indent=2))
    rows = raw.read_legacy_manifests(spark, str(tmp_path / "raw")).collect()
    assert [(r.media_id, r.mode, r.events_fetched, r.events_saved, r.status) for r in rows] == [("m1", "incremental", 2, 1, "success")]


def test_stream_dedup_forgets_beyond_the_watermark(spark, tmp_path):
    raw_root = str(tmp_path / "raw")
    rows = [
        Row(**{**{f.name: None for f in schemas.RAW_EVENT.fields}, "event_key": "k", "media_id": "m", "received_at": "2026-01-01T00:00:00.000Z"}),
        Row(**{**{f.name: None for f in schemas.RAW_EVENT.fields}, "event_key": "z", "media_id": "m", "received_at": "2026-03-01T00:00:00.000Z"}),
    ]
    land.land_events(spark.createDataFrame(rows[:2], schemas.RAW_EVENT), raw_root, "20260301T000000Z", "2026-03-01")
    late_copy = [Row(**{**rows[0].asDict(), "received_at": "2026-01-01T00:00:00.000Z"})]
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    stream.start_landing_stream(spark, raw_root, out, ckpt, watermark="1 day").awaitTermination()
    land.land_events(spark.createDataFrame(late_copy, schemas.RAW_EVENT), raw_root, "20260302T000000Z", "2026-03-02")
    stream.start_landing_stream(spark, raw_root, out, ckpt, watermark="1 day").awaitTermination()
    # The copy of "k" is older than the watermark: dropped as late, never doubled.
    assert sorted(r.event_key for r in spark.read.parquet(out).collect()) == ["k", "z"]
    # The batch transform's dedup is exact over all history regardless.
    assert st.dedup_events(raw.scan_events(spark, raw_root)).count() == 2


def test_malformed_records_are_quarantined(spark, tmp_path):
    page = tmp_path / "raw" / "run_date=2026-08-15" / "run_id=20260815T060000Z" / "events" / "media_id=m1" / "part-0.json"
    page.parent.mkdir(parents=True)
    page.write_text(
        '{"event_key": "a", "media_id": "m1", "received_at": "2026-08-15T07:51:28.000Z"}\n'
        "{this is not json\n"
        '{"event_key": "b", "media_id": "m1", "received_at": "2026-08-15T08:00:00.000Z"}\n'
    )
    df = raw.scan_events(spark, str(tmp_path / "raw"), keep_corrupt=True)
    good, corrupt = raw.split_corrupt(df)
    assert sorted(r.event_key for r in good.collect()) == ["a", "b"]
    bad = corrupt.collect()
    assert len(bad) == 1 and bad[0]._corrupt_record == "{this is not json" and bad[0]._source_file.endswith("part-0.json")
    assert "_corrupt_record" not in good.columns


def test_media_ids_survive_landing(spark, tmp_path):
    ids = ["a b:c", None, "x/y=z", "p+q", "100%"]
    rows = [{**{f.name: None for f in schemas.RAW_EVENT.fields}, "event_key": f"e{i}", "media_id": m, "received_at": "2024-01-02T00:00:00.000Z"} for i, m in enumerate(ids)]
    src = spark.createDataFrame([Row(**r) for r in rows], schemas.RAW_EVENT)
    land.land_events(src, str(tmp_path / "raw"), "20240102T060000Z", "2024-01-02")
    got = {r.event_key: r.media_id for r in raw.scan_events(spark, str(tmp_path / "raw")).collect()}
    assert got == {f"e{i}": m for i, m in enumerate(ids)}
    # an id that is only in the directory name is unescaped; the null partition is null
    paths = spark.createDataFrame([("f:/raw/events/media_id=a%20b%253Ac/p",), ("f:/raw/events/media_id=__HIVE_DEFAULT_PARTITION__/p",), ("f:/x",)], "p string")
    assert [r[0] for r in paths.select(raw.events_media_from_path("p")).collect()] == ["a b:c", None, ""]


def test_null_media_are_counted(spark, tmp_path):
    base = {f.name: None for f in schemas.RAW_EVENT.fields}
    src = spark.createDataFrame([Row(**{**base, "event_key": "a", "received_at": "2024-01-02T00:00:00.000Z"}), Row(**{**base, "event_key": "b", "media_id": "m", "received_at": "2024-01-02T00:00:00.000Z"})], schemas.RAW_EVENT)
    man = pipeline.run_landing(spark, src, None, str(tmp_path / "state"), str(tmp_path / "raw"), run_id="20240103T000000Z", run_date="2024-01-03")
    assert {r.media_id: (r.events_fetched, r.events_saved) for r in man.collect()} == {None: (1, 1), "m": (1, 1)}


def _landed(spark, root):
    return sorted((r.media_id or "-", r.event_key) for r in raw.scan_events(spark, str(root)).collect())


def test_null_media_lands_once_and_state_stays_bounded(spark, tmp_path):
    base = {f.name: None for f in schemas.RAW_EVENT.fields}
    rows = [Row(**{**base, "event_key": k, "media_id": m, "received_at": f"2024-01-0{d}T00:00:00.000Z"}) for k, m, d in [("a", None, 2), ("b", "m", 2), ("c", None, 3)]]
    src = spark.createDataFrame(rows, schemas.RAW_EVENT)
    raw_root, state_root = str(tmp_path / "raw"), str(tmp_path / "state")
    modes = []
    for day in range(1, 8):
        man = pipeline.run_landing(spark, src, None, state_root, raw_root, run_id=f"2024020{day}T000000Z", run_date=f"2024-02-0{day}")
        modes.append({r.media_id: r.mode for r in man.collect()})
    assert modes[0] == {None: "full", "m": "full"} and modes[1:] == [{None: "incremental", "m": "incremental"}] * 6
    assert _landed(spark, raw_root) == [("-", "a"), ("-", "c"), ("m", "b")]
    store = land.StateStore(spark, state_root)
    assert sorted((r.media_id or "-", r.last_received_at[:10]) for r in store.read().collect()) == [("-", "2024-01-03"), ("m", "2024-01-02")]
    assert len([p for p in os.listdir(state_root) if p.startswith("version=")]) == store.keep == 5
    # media that a run does not hold keep their marks, the null one too
    pipeline.run_landing(spark, src, ["m"], state_root, raw_root, run_id="20240209T000000Z", run_date="2024-02-09")
    assert sorted(r.media_id or "-" for r in store.read().collect()) == ["-", "m"]
    runs = raw.scan_runs(spark, raw_root).orderBy("run_id").collect()
    assert [(r.media_count, r.events_saved, r.status) for r in runs] == [(2, 3, "success")] + [(2, 0, "success")] * 6 + [(1, 0, "success")]
    assert all(r.started_at_utc <= r.finished_at_utc for r in runs)
    assert raw.scan_manifests(spark, raw_root).count() == 15


def test_failed_run_leaves_a_header_and_the_old_marks(spark, tmp_path):
    base = {f.name: None for f in schemas.RAW_EVENT.fields}
    src = spark.createDataFrame([Row(**{**base, "event_key": "a", "media_id": "m", "received_at": "2024-01-02T00:00:00.000Z"})], schemas.RAW_EVENT)
    bad = src.withColumn("event_key", F.raise_error(F.lit("source is gone")))
    for run_id, source in (("20240201T000000Z", src), ("20240202T000000Z", bad)):
        try:
            pipeline.run_landing(spark, source, ["m"], str(tmp_path / "state"), str(tmp_path / "raw"), run_id=run_id, run_date="2024-02-01")
        except Exception:  # noqa: BLE001
            assert run_id == "20240202T000000Z"
    runs = {r.run_id: r for r in raw.scan_runs(spark, str(tmp_path / "raw")).collect()}
    assert runs["20240201T000000Z"].status == "success" and runs["20240202T000000Z"].status == "failed" and "source is gone" in runs["20240202T000000Z"].error
    assert land.StateStore(spark, str(tmp_path / "state")).latest() == "20240201T000000Z"


def test_dated_source_reads_only_open_days(spark, tmp_path):
    base = {f.name: None for f in schemas.RAW_EVENT.fields}
    rows = [Row(**{**base, "event_key": f"{m}{d}", "media_id": m, "received_at": f"2024-01-{d:02d}T05:00:00.000Z"}) for m in ("a", "b", "new") for d in range(1, 11)]
    rows += [Row(**{**base, "event_key": f"bad{m}", "media_id": m, "received_at": "soon"}) for m in ("a", "other")]
    src = spark.createDataFrame(rows, schemas.RAW_EVENT)
    source = DatedSource.write(src, str(tmp_path / "source"))
    state = spark.createDataFrame([("a", "2024-01-08T05:00:00.000Z"), ("b", "2024-01-06T01:00:00.000Z")], schemas.STATE)

    def both(media):
        plans = [plan_landing(s, state, media, run_id="r", run_date="d") for s in (src, source)]
        for name in ("fetched", "saved", "manifest", "new_state"):
            one, two = (getattr(p, name) for p in plans)
            assert sorted(map(str, one.select(*sorted(one.columns)).collect())) == sorted(map(str, two.select(*sorted(two.columns)).collect())), name
        return plans[1].fetched

    fetched = both(["a", "b"])
    plan = fetched._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [((event_day" in plan and "2024-01-06" in plan
    scan = source._stored().where("event_day >= date'2024-01-06' or event_day is null").select(F.col("_metadata.file_path").alias("f")).distinct().count()
    assert scan == 6 < source._stored().select(F.col("_metadata.file_path").alias("f")).distinct().count() == 11
    assert both(["a", "new"]).where("media_id = 'new'").count() == 10  # a media without a mark has all days
    assert both(["new"]).count() == 10 and both(None).count() > 10
    man = pipeline.run_landing(spark, source, None, str(tmp_path / "state"), str(tmp_path / "raw"), run_id="20240201T000000Z", run_date="2024-02-01")
    assert man.agg(F.sum("events_saved")).first()[0] == 30


def test_uncommitted_state_is_ignored(spark, tmp_path):
    store = land.StateStore(spark, str(tmp_path / "state"))
    store.write(spark.createDataFrame([("a", "1"), ("b", "1")], schemas.STATE), "20260101T000000Z")
    spark.createDataFrame([("a", "2")], schemas.STATE).write.parquet(str(tmp_path / "state" / "version=20260102T000000Z"))
    assert sorted(tuple(r) for r in store.read().collect()) == [("a", "1"), ("b", "1")]
    store.write(spark.createDataFrame([("a", "3")], schemas.STATE), "20260102T000000Z")  # the run again
    assert [tuple(r) for r in store.read().collect()] == [("a", "3")]


def test_malformed_records_are_no_events(spark, tmp_path):
    page = tmp_path / "raw" / "run_date=2026-08-15" / "run_id=20260815T060000Z" / "events" / "media_id=m1" / "part-0.json"
    page.parent.mkdir(parents=True)
    page.write_text('{"event_key": "a", "media_id": "m1"}\n{broken\n')
    events = raw.scan_events(spark, str(tmp_path / "raw"))
    assert [r.event_key for r in events.collect()] == ["a"] and events.count() == 1


def test_stream_reads_array_pages(spark, tmp_path):
    events = [{"event_key": f"k{i}", "media_id": "m1", "received_at": "2026-08-15T07:51:28.000Z"} for i in range(5)]
    page = tmp_path / "raw" / "run_date=2026-08-15" / "run_id=20260815T060000Z" / "events" / "media_id=m1" / "page_001.json"
    _write_page(str(page), events)
    out = str(tmp_path / "out")
    stream.start_landing_stream(spark, str(tmp_path / "raw"), out, str(tmp_path / "ckpt")).awaitTermination()
    assert sorted(r.event_key for r in spark.read.parquet(out).collect()) == [f"k{i}" for i in range(5)]


def test_landed_texts_are_split_and_read_once(spark):
    """Each line of a landed text is looked at once, each record read once, though good ones are kept apart from malformed ones."""
    files = spark.createDataFrame([("a.json", '[\n{\n  "event_key" : "e1"\n},\n{\n  "event_key" : "e2"\n}\n]\n'), ("b.json", '{"event_key": "e3"}\n{"event_key": "cut\n')], "_source_file string, text string")
    records = files.select(F.inline(records_of_text(F.col("text"))), "_source_file")
    good, corrupt = split_corrupt(parsed(records, schemas.RAW_EVENT))
    assert sorted(r.event_key for r in good.collect()) == ["e1", "e2", "e3"]
    assert [(r._corrupt_record, r._source_file) for r in corrupt.collect()] == [('{"event_key": "cut', "b.json")]
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("from_json(StructField(event_key") == 1
