"""The command line runs the steps on a standalone trip file."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from strata.__main__ import main
from strata.plans import fixtures as X
from strata.sources import audit as A
from tests.conftest import ROOT, SF_SMALL

PERIOD = ["--start", X.PERIOD_START, "--end", X.PERIOD_END]


def test_cli_steps(spark, tmp_path):
    raw = str(tmp_path / "trips.parquet")
    X.trips_clean(spark, SF_SMALL).write.parquet(raw)
    root = ["--root", str(tmp_path / "root"), "--run-id", "cli-test"]
    assert main(["check-raw", "--raw", raw, *PERIOD]) == 0
    assert main(["run", "--raw", raw, *PERIOD, *root]) == 0
    assert main(["check-silver", *PERIOD, *root]) == 0
    full = str(tmp_path / "full.parquet")
    X.trips(spark, SF_SMALL).write.parquet(full)
    assert main(["check-raw", "--raw", full, *PERIOD]) == 1  # NULL timestamps fail the gate
    assert main(["run", "--raw", full, *PERIOD, "--root", str(tmp_path / "root2")]) == 1


def test_steps_as_separate_processes(spark, tmp_path):
    raw, root = str(tmp_path / "trips.parquet"), str(tmp_path / "root")
    X.trips(spark, SF_SMALL).write.parquet(raw)

    def step(*args):
        done = subprocess.run(
            [sys.executable, "-m", "strata", *args, *PERIOD, "--root", root, "--run-id", "apart"],
            cwd=tmp_path, env=os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": "--conf spark.ui.enabled=false pyspark-shell"},
            capture_output=True, text=True, timeout=300)
        return done.returncode, done.stdout

    assert step("bronze", "--raw", raw)[0] == 0
    code, out = step("silver")
    assert code == 0 and "'status': 'SUCCESS'" in out
    assert step("check-silver")[0] == 0


def test_missing_raw_file_is_audited_by_a_run(spark, tmp_path):
    root = str(tmp_path / "root")
    with pytest.raises(FileNotFoundError):
        main(["run", "--raw", str(tmp_path / "absent.parquet"), *PERIOD, "--root", root])
    (row,) = A.read_audit(spark, f"{root}/audit").collect()
    assert (row["status"], row["error_type"]) == (A.FAILED, "FileNotFoundError")


def test_raw_gate_may_report_only(spark, tmp_path):
    full = str(tmp_path / "full.parquet")
    X.trips(spark, SF_SMALL).write.parquet(full)
    assert main(["run", "--raw", full, *PERIOD, "--root", str(tmp_path / "r"), "--raw-gate", "report"]) == 0
