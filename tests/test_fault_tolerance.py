"""Tasks that fail and are retried do not change the distributed ranks."""

import os
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))


@pytest.mark.slow
def test_distributed_rank_survives_task_retries():
    out = subprocess.run([sys.executable, os.path.join(HERE, "fault_injection_job.py")],
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith(("OK", "MISMATCH"))]
    assert lines == ["OK 4000"], out.stdout[-2000:] + out.stderr[-2000:]
