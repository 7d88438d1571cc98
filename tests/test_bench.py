"""bench.py prints exactly one JSON line with the agreed fields."""

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEATS="1",
               BENCH_QUERIES="token_liquidity_risk_top50,stablecoin_depeg_risk_top50",
               BENCH_DRIVER_MEMORY="2g", BENCH_EVENT_LOG_DIR=f"file://{tmp_path}")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"token_liquidity_risk_top50", "stablecoin_depeg_risk_top50"}
    assert abs(result["value"] - sum(result["queries"].values())) < 1e-6

    sys.path.insert(0, str(ROOT / "tools"))
    import stage_times

    stages = stage_times.stages(str(tmp_path))
    assert stages and all(s["wall_ms"] >= 0 for s in stages)
    assert any(s["what"].startswith("token_liquidity_risk_top50") for s in stages)


def test_modules_import_without_a_session():
    code = ("import __spark_entry__ as e, tidemark.cli, tidemark.plans.job, tidemark.streaming.incremental; "
            "print(len(e.queries()), len(e.oracle_sql()))")
    out = subprocess.run([sys.executable, "-c", code], cwd="/tmp", env=dict(os.environ, PYTHONPATH=str(ROOT)),
                         capture_output=True, text=True, timeout=120, check=True)
    n_queries, n_oracles = map(int, out.stdout.split())
    assert n_queries >= n_oracles > 50
