"""The stage-time summary reads Spark's event log (plain or rolling folders)."""

import json
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def _stage(sid, start, end, tasks, name):
    info = {"Stage ID": sid, "Submission Time": start, "Completion Time": end, "Number of Tasks": tasks, "Stage Name": name}
    return json.dumps({"Event": "SparkListenerStageCompleted", "Stage Info": info})


def test_stage_times_lists_slowest_first(tmp_path):
    folder = tmp_path / "eventlog_v2_local-1"
    folder.mkdir()
    lines = [json.dumps({"Event": "SparkListenerApplicationStart"}), _stage(0, 0, 1000, 8, "write"), _stage(1, 0, 3000, 2499, "count")]
    (folder / "events_1_local-1").write_text("\n".join(lines) + "\n")
    out = subprocess.run([sys.executable, str(ROOT / "tools" / "stage_times.py"), str(tmp_path)], capture_output=True, text=True, timeout=60)
    assert out.returncode == 0, out.stderr
    rows = out.stdout.splitlines()
    assert rows[0].startswith("2 stages, 4.0 s")
    assert "count" in rows[1] and "2499" in rows[1] and "write" in rows[2]


def test_cheap_bench_jobs_run(spark):
    """Fixtures of the bench jobs follow the queries' helpers; the jobs of many days share theirs with these."""
    import bench

    for name in ("slice_day", "append_twice", "csv_relay"):
        assert bench.BENCHES[name](spark, "/root/testdata/sf0.001") > 0
