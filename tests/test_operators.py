"""Unit tests on tiny inline frames: the edge rows of FIXTURES.md section 4."""

from __future__ import annotations

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from reelstar import schemas
from reelstar.functions import columns as fn
from reelstar.operators import quality as dq
from reelstar.operators.landing import plan_landing
from reelstar.operators.latest import dedup
from reelstar.plans import analytics as an
from reelstar.plans import star as st

MARK = "2026-08-15T07:51:28.000Z"
R1 = "raw/run_date=2026-08-15/run_id=20260815T060000Z"
R2 = "raw/run_date=2026-08-16/run_id=20260816T060000Z"


def ev(**kw):
    base = {f.name: None for f in schemas.RAW_EVENT.fields}
    base.update(kw)
    return base


def events_df(spark, rows, with_path=None):
    df = spark.createDataFrame([Row(**r) for r in rows], schemas.RAW_EVENT) if rows else spark.createDataFrame([], schemas.RAW_EVENT)
    if with_path is not None:
        df = df.withColumn("_source_file", F.lit(with_path))
    return df


def state_df(spark, marks):
    return spark.createDataFrame(list(marks.items()), schemas.STATE)


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


# ---- landing ---------------------------------------------------------------------


def test_incremental_saves_only_newer(spark):
    # The reference's own unit test: 2 fetched, 1 saved, equal timestamp excluded.
    src = events_df(
        spark,
        [
            ev(event_key="already-processed", media_id="test-media", received_at=MARK),
            ev(event_key="new-event", media_id="test-media", received_at="2026-08-15T08:00:00.000Z"),
        ],
    )
    plan = plan_landing(src, state_df(spark, {"test-media": MARK}), run_id="r", run_date="d")
    m = by(plan.manifest, "media_id")["test-media"]
    assert m["mode"] == "incremental"
    assert m["events_fetched"] == 2 and m["events_saved"] == 1
    assert [r.event_key for r in plan.saved.collect()] == ["new-event"]
    assert m["checkpoint_after"] == "2026-08-15T08:00:00.000Z"


def test_landing_edge_rows(spark):
    src = events_df(
        spark,
        [
            ev(event_key="eq", media_id="a", received_at=MARK),
            ev(event_key="new", media_id="a", received_at="2026-08-15T09:00:00.000Z"),
            ev(event_key="nul", media_id="a", received_at=None),
            ev(event_key="empty", media_id="a", received_at=""),
            ev(event_key="bad", media_id="a", received_at="not-a-time"),
            ev(event_key="earlier-same-day", media_id="a", received_at="2026-08-15T01:00:00.000Z"),
            ev(event_key="day-before", media_id="a", received_at="2026-08-14T23:00:00.000Z"),
            ev(event_key="b1", media_id="b", received_at="2020-01-01T00:00:00.000Z"),
            ev(event_key="x1", media_id="x", received_at="2027-01-01T00:00:00.000Z"),
        ],
    )
    state = state_df(spark, {"a": MARK, "c": "2026-01-01T00:00:00.000Z", "d": "2025-01-01T00:00:00.000Z"})
    plan = plan_landing(src, state, ["a", "b", "c"], run_id="r", run_date="d")
    man = by(plan.manifest, "media_id")
    assert set(man) == {"a", "b", "c"}  # x is not configured, d only carried
    a, b, c = man["a"], man["b"], man["c"]
    # fetched: everything from the mark's day on, plus records without a time
    assert a["events_fetched"] == 6 and a["events_saved"] == 1 and a["events_rejected"] == 1
    assert a["checkpoint_after"] == "2026-08-15T09:00:00.000Z" and a["pages_fetched"] == 1
    assert b["mode"] == "full" and b["events_saved"] == 1 and b["checkpoint_after"] == "2020-01-01T00:00:00.000Z"
    assert c["mode"] == "incremental" and c["events_fetched"] == 0 and c["pages_fetched"] == 0
    assert c["checkpoint_after"] == c["checkpoint_before"]
    assert sorted(r.event_key for r in plan.saved.collect()) == ["b1", "new"]
    new_state = {r.media_id: r.last_received_at for r in plan.new_state.collect()}
    assert new_state == {
        "a": "2026-08-15T09:00:00.000Z",
        "b": "2020-01-01T00:00:00.000Z",
        "c": "2026-01-01T00:00:00.000Z",
        "d": "2025-01-01T00:00:00.000Z",
    }


def test_lookback_relands_equal_time(spark):
    src = events_df(spark, [ev(event_key="eq", media_id="a", received_at=MARK)])
    plan = plan_landing(src, state_df(spark, {"a": MARK}), run_id="r", run_date="d", lookback_seconds=60)
    assert [r.event_key for r in plan.saved.collect()] == ["eq"]


def test_pages_counted_like_the_api(spark):
    rows = [ev(event_key=f"e{i}", media_id="a", received_at=f"2026-08-15T10:{i // 60:02d}:{i % 60:02d}.000Z") for i in range(200)]
    plan = plan_landing(events_df(spark, rows), state_df(spark, {}), run_id="r", run_date="d")
    m = by(plan.manifest, "media_id")["a"]
    assert (m["events_fetched"], m["pages_fetched"], m["mode"]) == (200, 2, "full")


# ---- dedup -----------------------------------------------------------------------------


def test_null_keys_collapse_to_one(spark):
    df = events_df(spark, [ev(event_key=None, received_at="2026-01-01T00:00:00.000Z"), ev(event_key=None, received_at="2026-01-02T00:00:00.000Z")], R1 + "/events/media_id=a/p.json")
    assert st.dedup_events(df).count() == 1
    assert st.dedup_events(df, null_keys="keep_all").count() == 2
    assert st.dedup_events(df, null_keys="drop").count() == 0


def test_latest_copy_wins_then_latest_run(spark):
    a = events_df(spark, [ev(event_key="k", media_url="old", received_at="2026-01-01T00:00:00.000Z"), ev(event_key="t", media_url="run1", received_at="2026-01-05T00:00:00.000Z")], R1 + "/events/media_id=a/p.json")
    b = events_df(spark, [ev(event_key="k", media_url="new", received_at="2026-01-02T00:00:00.000Z"), ev(event_key="t", media_url="run2", received_at="2026-01-05T00:00:00.000Z")], R2 + "/events/media_id=a/p.json")
    out = by(st.dedup_events(a.unionByName(b)), "event_key")
    assert out["k"]["media_url"] == "new"
    assert out["t"]["media_url"] == "run2"


def test_dedup_independent_of_partitioning(spark):
    rows = [(i % 97, i, f"v{i % 5}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    order = [F.col("o").desc()]
    one = sorted(tuple(r) for r in dedup(df.repartition(1), ["k"], order).collect())
    many = sorted(tuple(r) for r in dedup(df.repartition(13, "v"), ["k"], order).collect())
    assert one == many and len(one) == 97


# ---- star schema ---------------------------------------------------------------------------


@pytest.fixture()
def small_star(spark):
    events = events_df(
        spark,
        [
            ev(event_key="e1", media_id="m1", media_url="https://www.YouTube.com/watch", visitor_key="v1", received_at="2026-08-15T07:00:00.000Z", percent_viewed=0.75, user_agent_details=Row(browser="b", platform="p", mobile=True)),
            ev(event_key="e2", media_id="m1", media_url=None, visitor_key=None, received_at="2026-08-15T08:00:00.000Z", percent_viewed=None),
            ev(event_key="e3", media_id="m9", media_url="https://facebook.com/x", visitor_key="v1", received_at="2026-08-15T23:51:28.000Z", percent_viewed=0.5),
        ],
        R1 + "/events/media_id=m1/page_001.json",
    )
    meta = spark.createDataFrame(
        [
            ("m1", "Intro", "2026-01-01T00:00:00.000Z", "2026-02-01T00:00:00.000Z", 120.0, "ready", R1 + "/media_metadata.json"),
            ("m1", "Intro v2", "2026-01-01T00:00:00.000Z", "2026-02-01T00:00:00.000Z", 120.0, "ready", R2 + "/media_metadata.json"),
            ("m2", "Quiet", "2026-01-01T00:00:00.000Z", "2026-01-02T00:00:00.000Z", 60.0, "ready", R1 + "/media_metadata.json"),
        ],
        "hashed_id string, name string, created string, updated string, duration double, status string, _source_file string",
    )
    stats = spark.createDataFrame([(0.4, R1 + "/media_stats/m1.json"), (0.6, R2 + "/media_stats/m1.json")], "play_rate double, _source_file string")
    return st.build_star(events, meta, stats)


def test_dim_media_edges(small_star):
    dm = by(small_star.dim_media, "media_id")
    assert set(dm) == {"m1", "m2"}
    assert dm["m1"]["title"] == "Intro v2"  # equal `updated`: the later run wins
    assert dm["m1"]["url"] is None and dm["m1"]["channel"] is None  # latest event has a null URL
    assert dm["m2"]["url"] is None and dm["m2"]["channel"] is None  # media without events


def test_fact_edges(small_star):
    f = by(small_star.fact, "engagement_id")
    assert len(f) == 3
    assert f["e1"]["total_watch_time"] == 90.0 and f["e1"]["watched_percent"] == 75.0
    assert f["e1"]["play_rate"] == 0.6 and f["e1"]["play_count"] == 1  # latest stats
    assert f["e2"]["visitor_id"] is None and f["e2"]["total_watch_time"] is None
    assert f["e3"]["total_watch_time"] is None and f["e3"]["play_rate"] is None  # unknown media
    assert str(f["e3"]["date"]) == "2026-08-15"  # UTC session keeps the day
    dv = small_star.dim_visitor.collect()
    assert len(dv) == 1 and dv[0].visitor_id == fn_sha("v1")


def fn_sha(s):
    import hashlib

    return hashlib.sha256(s.encode()).hexdigest()


def test_unknown_media_by_media_not_by_title(small_star):
    media = {r.media_id for r in an.by_media(small_star.fact).collect()}
    titles = {r.title for r in an.by_title(small_star.fact, small_star.dim_media).collect()}
    assert "m9" in media and titles == {"Intro v2"}


def test_session_zone_moves_date(spark):
    df = spark.createDataFrame([("2026-08-15T23:51:28.000Z",)], "s string")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert str(df.select(fn.event_date(fn.parse_ts("s"))).first()[0]) == "2026-08-16"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert str(df.select(fn.event_date(fn.parse_ts("s"))).first()[0]) == "2026-08-15"


def test_channel_rules(spark):
    df = spark.createDataFrame(
        [("https://YouTube.com/facebook",), ("https://www.FACEBOOK.com/v",), ("https://vimeo.com/1",), (None,)], "u string"
    )
    assert [r[0] for r in df.select(fn.channel_of("u")).collect()] == ["YouTube", "Facebook", None, None]


def test_bad_timestamp_is_rejected_not_raised(spark):
    df = spark.createDataFrame([("2026-08-15T07:51:28.000Z",), ("garbage",), ("",), (None,)], "s string")
    out = df.select(fn.parse_ts("s").isNull().alias("n"), fn.is_rejected_ts("s").alias("r")).collect()
    assert [(r.n, r.r) for r in out] == [(False, False), (True, True), (True, False), (True, False)]


def test_round2_half_way(spark):
    df = spark.createDataFrame([(2.675,), (-2.675,), (1.005,), (None,)], "x double")
    assert [r[0] for r in df.select(fn.round2("x")).collect()] == [2.68, -2.68, 1.01, None]
    odd = spark.createDataFrame([(0.0049999999999,), (1e30,), (float("nan"),)], "x double").select(fn.round2("x")).collect()
    assert [r[0] for r in odd][:2] == [0.0, 1e30] and odd[2][0] != odd[2][0]


def test_exact_sum_does_not_depend_on_order(spark):
    values = [(1, x) for x in (0.1, 0.2, 0.3, 1e9, -1e9)] + [(2, 1e300), (2, 1.0), (3, None)]
    for rows in (values, values[::-1]):
        got = {r.g: r.s for r in spark.createDataFrame(rows, "g int, x double").repartition(3).groupBy("g").agg(fn.exact_sum("x").alias("s")).collect()}
        assert got == {1: 0.6, 2: 1e300, 3: None}


def test_dedup_of_rows_whose_nulls_stand_elsewhere(spark):
    rows = [("k", "X", None), ("k", None, "X")]
    kept = set()
    for some in (rows, rows[::-1]):
        for parts in (1, 2, 5):
            df = spark.createDataFrame(some, "key string, country string, region string").repartition(parts)
            kept.add(tuple(dedup(df, "key").first()))
    assert len(kept) == 1


# ---- quality -------------------------------------------------------------------------------


def test_quality_report_and_gate(small_star):
    rep = dq.quality_report(small_star.fact, small_star.dim_media, small_star.dim_visitor).first()
    assert rep.fact_rows == 3 and rep.duplicate_engagement_ids == 0
    assert rep.orphan_media_rows == 1 and rep.passed is False
    with pytest.raises(dq.QualityError):
        dq.assert_quality(dq.quality_report(small_star.fact, small_star.dim_media, small_star.dim_visitor))


def test_duplicates_and_range_reports(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 1.5), (None, None), ("b", -0.1)], "k string, p double")
    d = dq.duplicates_report(df, "k").first()
    assert (d.rows, d.distinct_keys, d.duplicate_rows, d.missing_keys) == (4, 2, 1, 1)
    r = dq.range_report(df, "p").first()
    assert (r.out_of_range, r.null_values, r.min_value, r.max_value) == (2, 1, -0.1, 1.5)


def test_coarse_day_is_the_marks_own_offset(spark):
    mark = "2026-08-15T01:30:00.000+02:00"  # = 2026-08-14T23:30Z; its own day starts 2026-08-14T22:00Z
    src = events_df(
        spark,
        [
            ev(event_key="in-day", media_id="a", received_at="2026-08-14T22:30:00.000Z"),
            ev(event_key="before-day", media_id="a", received_at="2026-08-14T21:00:00.000Z"),
            ev(event_key="after", media_id="a", received_at="2026-08-15T00:00:00.000Z"),
        ],
    )
    plan = plan_landing(src, state_df(spark, {"a": mark}), run_id="r", run_date="d")
    assert sorted(r.event_key for r in plan.fetched.collect()) == ["after", "in-day"]
    assert [r.event_key for r in plan.saved.collect()] == ["after"]


def test_lookback_into_the_previous_day_fetches_that_day(spark):
    mark = "2026-08-15T00:30:00.000Z"
    src = events_df(spark, [ev(event_key="late-prev-day", media_id="a", received_at="2026-08-14T23:45:00.000Z")])
    strict = plan_landing(src, state_df(spark, {"a": mark}), run_id="r", run_date="d")
    assert strict.fetched.count() == 0
    back = plan_landing(src, state_df(spark, {"a": mark}), run_id="r", run_date="d", lookback_seconds=3600)
    assert [r.event_key for r in back.saved.collect()] == ["late-prev-day"]


def test_unparseable_mark_reloads_in_full_and_is_replaced(spark):
    src = events_df(spark, [ev(event_key="e1", media_id="a", received_at="2026-08-15T09:00:00.000Z")])
    plan = plan_landing(src, state_df(spark, {"a": "garbage"}), run_id="r", run_date="d")
    m = by(plan.manifest, "media_id")["a"]
    assert (m["mode"], m["checkpoint_before"], m["checkpoint_after"], m["events_saved"]) == (
        "full", "garbage", "2026-08-15T09:00:00.000Z", 1)
    assert {r.media_id: r.last_received_at for r in plan.new_state.collect()} == {"a": "2026-08-15T09:00:00.000Z"}


def test_profile_skips_malformed_records(spark):
    from reelstar.operators import profile as pf

    recs = spark.createDataFrame([('{"a": 1, "b": {"c": true}}',), ("not json",), ('{"a": "x"}',)], "json string")
    got = sorted((r.field, r.json_type, r.records) for r in pf.field_profile(spark, recs).collect())
    assert got == [("a", "number", 1), ("a", "string", 1), ("b", "object", 1)]
    nested = [(r.field, r.json_type) for r in pf.nested_profile(spark, recs).collect()]
    assert nested == [("b.c", "boolean")]


def test_profile_walks_every_depth(spark):
    from reelstar.operators import profile as pf

    recs = spark.createDataFrame(
        [
            ('{"a": {"b": {"c": {"d": 1}}}, "l": [{"x": 1, "y": [true, null]}, {"x": "s"}, 7]}',),
            ('{"a": {"b": null}, "l": [], "m": [[1, 2], []]}',),
            ('[{"a": {"b": 2}}]',),
            ("{cut",),
            (None,),
            ("3",),
        ],
        "json string",
    )
    got = {(r.parent, r.field, r.json_type): (r.records, r.min_array_length, r.max_array_length) for r in pf.nested_profile(spark, recs).collect()}
    assert got == {
        ("a", "a.b", "object"): (1, None, None),
        ("a", "a.b", "null"): (1, None, None),
        ("a.b", "a.b.c", "object"): (1, None, None),
        ("a.b.c", "a.b.c.d", "number"): (1, None, None),
        ("l", "l[]", "object"): (2, 3, 3),
        ("l", "l[]", "number"): (1, 3, 3),
        ("l", "l[]", "empty"): (1, 0, 0),
        ("l[]", "l[].x", "number"): (1, None, None),
        ("l[]", "l[].x", "string"): (1, None, None),
        ("l[]", "l[].y", "array"): (1, None, None),
        ("l[].y", "l[].y[]", "boolean"): (1, 2, 2),
        ("l[].y", "l[].y[]", "null"): (1, 2, 2),
        ("m", "m[]", "array"): (2, 2, 2),
        ("m[]", "m[][]", "number"): (2, 2, 2),
        ("m[]", "m[][]", "empty"): (1, 0, 0),
        ("$[]", "$[].a", "object"): (1, None, None),
        ("$[].a", "$[].a.b", "number"): (1, None, None),
    }
    totals = {(r.field, r.json_type): r.records for r in pf.field_profile(spark, recs, totals=True).collect()}
    assert {k: v for k, v in totals.items() if k[0] == "$"} == {("$", "record"): 6, ("$", "object"): 2, ("$", "array"): 1, ("$", "number"): 1, ("$", "rejected"): 2}
    assert totals[("a", "object")] == 2 and totals[("m", "array")] == 1
    assert pf.nested_profile(spark, recs.limit(0)).count() == 0 and pf.field_profile(spark, recs.limit(0), totals=True).count() == 0


def test_survivors_do_not_depend_on_where_the_tree_stands(spark):
    from reelstar.operators.latest import dedup

    rows = [(i % 20, f"v{i}", f"run_date=2024-01-0{1 + i % 3}/run_id=r{i % 7}/events/media_id=m/page_{i}.json") for i in range(200)]
    kept = []
    for root in ("file:/a/raw/", "s3://bucket/elsewhere/", ""):
        frame = spark.createDataFrame([(k, v, root + p) for k, v, p in rows], "k int, v string, _source_file string")
        kept.append(sorted((r.k, r.v) for r in dedup(frame, "k").collect()))
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 20
