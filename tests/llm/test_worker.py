"""Tasks must not need this package on the executors."""

from __future__ import annotations

import subprocess
import sys
import textwrap

import pytest


def test_queries_run_from_another_folder(tmp_path, folder):
    """A session started elsewhere, whose Python workers cannot import the package."""
    code = f"""
    import sys
    sys.path.insert(0, {str(__import__("pathlib").Path(__file__).parents[2])!r})
    import __spark_entry__ as entry
    from tradewind.session import build_session
    spark = build_session("elsewhere", "local[4]", **{{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": {str(tmp_path / "shared")!r}}})
    spark.sparkContext.setLogLevel("ERROR")
    queries = entry.queries()
    for name in queries:
        if name == "pipeline" or name.startswith("op"):
            print(name, queries[name](spark, {folder!r}).count())
    """
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    assert run.returncode == 0, run.stderr[-2000:]
    assert run.stdout.count("\n") == 14


def test_kept_values_are_made_once():
    from tradewind.llm.worker import remembered

    made = []
    for _ in range(3):
        assert remembered(("test", 1), lambda: made.append(1) or "x") == "x"
    assert made == [1]


@pytest.mark.parametrize("most", [40, 1 << 20])
def test_halved_stretches_lose_nothing(most, monkeypatch):
    from tradewind.llm import decontaminate as D

    monkeypatch.setattr(D, "SHARED", most)
    passage = "de de de de the quick de de brown fox de de jumps over de de the lazy dog de de"
    index = D.Index([1], [passage], D.Rules())
    text = "de " * 5000 + passage + " de" * 7000
    assert index.leaks(text)[1][0] == 0 and not index.leaks("de " * 9000)
