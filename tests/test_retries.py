"""Tasks that fail and are retried give the same, whole results."""

import json
import os
import subprocess
import sys

JOB = os.path.join(os.path.dirname(os.path.abspath(__file__)), "jobs", "retry_job.py")


def test_results_survive_task_retries(tmp_path):
    marks = tmp_path / "marks"
    marks.mkdir()
    proc = subprocess.run([sys.executable, JOB, "/root/testdata/sf0.001", str(marks)],
                          capture_output=True, text=True, timeout=600, cwd=str(tmp_path))
    lines = [ln for ln in proc.stdout.splitlines() if ln.startswith("{")]
    assert lines, proc.stderr[-3000:]
    out = json.loads(lines[-1])
    for key, (ok, n_spark, n_oracle) in out.items():
        assert ok, f"{key}: spark={n_spark} oracle={n_oracle}"
    failed = sorted(p.name.split("-")[0] for p in marks.iterdir())
    assert "html" in failed and "join" in failed  # failures really happened and were retried
