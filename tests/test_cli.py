"""The command-line jobs, run in-process on the test session."""

from __future__ import annotations

import json


from reelstar import cli
from reelstar.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_land_transform_validate_profile(spark, tmp_path, capsys):
    src = str(tmp_path / "source")
    fx.source_events(spark, SF).write.parquet(src)
    raw_root, state, curated = str(tmp_path / "raw"), str(tmp_path / "state"), str(tmp_path / "curated")
    assert cli.main(["--limit", "100000", "land", "--source", src, "--state", state, "--raw", raw_root,
                     "--run-id", "20240201T060000Z", "--run-date", "2024-02-01"], spark) == 0
    manifest = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert sum(m["events_saved"] for m in manifest) == 1000 and {m["mode"] for m in manifest} == {"full"}

    fx.raw_metadata(spark, SF).drop("_source_file").write.json(f"{raw_root}/run_date=2024-02-01/run_id=20240201T060000Z/media_metadata.json")
    assert cli.main(["transform", "--raw", raw_root, "--curated", curated, "--db", "reelstar_cli",
                     "--channel-rule", "blog.=Blog"], spark) == 0
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts["fact_media_engagement"] == 1000

    # a malformed record is quarantined, not transformed
    bad_dir = tmp_path / "raw" / "run_date=2024-02-02" / "run_id=20240202T060000Z" / "events" / "media_id=m1"
    bad_dir.mkdir(parents=True)
    (bad_dir / "part-bad.json").write_text("{broken\n")
    q_root, q_path = str(tmp_path / "curated_q"), str(tmp_path / "quarantine")
    assert cli.main(["transform", "--raw", raw_root, "--curated", q_root, "--quarantine", q_path], spark) == 0
    q_counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert q_counts["quarantined_records"] == 1 and q_counts["quarantined_records_by_kind"] == {"events": 1} and q_counts["fact_media_engagement"] == 1000

    inc_root = str(tmp_path / "curated_inc")
    assert cli.main(["transform", "--raw", raw_root, "--curated", inc_root, "--incremental",
                     "--runs", "run_date=2024-02-01/run_id=*", "--channel-rule", "blog.=Blog"], spark) == 0
    inc_counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert inc_counts == {k: counts[k] for k in inc_counts}

    answers = str(tmp_path / "answers")
    assert cli.main(["--limit", "3", "validate", "--db", "reelstar_cli", "--out", answers], spark) == 0
    out = capsys.readouterr().out.splitlines()
    full = spark.read.parquet(f"{answers}/sql_by_media").count()
    assert full > 3 and sum(1 for x in out if '"estimated_watch_seconds"' in x) == 3  # preview only, full answer written
    assert {"query": "sql_watch_minutes"} in [json.loads(x) for x in out]
    assert json.loads(out[-1])["quality"]["fact_rows"] == 1000
    assert cli.main(["validate", "--db", "reelstar_cli", "--fail-on-quality"], spark) == 2  # unknown media -> orphans
    capsys.readouterr()

    assert cli.main(["profile", "--path", f"{raw_root}/run_date=*/run_id=*/events/media_id=*/part-*", "--nested"], spark) == 0
    prof = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    fields = {p["field"] for p in prof}
    assert {"event_key", "received_at", "user_agent_details", "user_agent_details.mobile"} <= fields
