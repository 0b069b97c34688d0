"""The library without its optional subpackage."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = """
import __spark_entry__ as entry
known, sql = entry.queries(), entry.oracle_sql()
print(len(known), sum(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in known), set(sql) <= set(known))
"""


def answer(folder) -> list[str]:
    done = subprocess.run([sys.executable, "-c", ASK], cwd=folder, capture_output=True, text=True, timeout=120, check=True)
    return done.stdout.split()


def test_queries_without_the_subpackage(tmp_path):
    def left_out(folder, names):
        return {n for n in names if n in (".git", "__pycache__", "spark-warehouse") or n == "llm" and os.path.basename(folder) in ("motionloom", "tests")}
    shutil.copytree(HERE, tmp_path / "with_pipeline", ignore=left_out)
    shutil.copytree(tmp_path / "with_pipeline", tmp_path / "without", ignore=shutil.ignore_patterns("corpus_pipeline.py"))
    for name in ("with_pipeline", "without"):
        n, optional, complete = answer(tmp_path / name)
        assert int(n) > 100 and optional == "0" and complete == "True"
