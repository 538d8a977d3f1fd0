import subprocess
import sys
from pathlib import Path

import pytest

from winnowry import session

ROOT = Path(__file__).resolve().parents[1]


def test_cut_and_clear(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: f"file://{tmp_path}")
    monkeypatch.setattr(spark, "_winnowry_cuts", [], raising=False)
    df = session.cut(spark.range(3), "x")
    assert df.count() == 3 and len(list(tmp_path.glob("x-*"))) == 1
    assert session.clear(spark) == 1 and not list(tmp_path.glob("x-*")) and session.clear(spark) == 0
    spark._winnowry_cuts = []


def test_a_cluster_must_name_its_folder():
    class Session:
        conf = {"spark.master": "spark://host:7077"}

    with pytest.raises(ValueError):
        session.shared_dir(Session())


def test_core_works_without_what_llm_needs():
    code = """
import sys
for name in sys.argv[1:]:
    sys.modules[name] = None
import __spark_entry__ as e
q = e.queries()
assert "rule_classify" in q and "pipeline" not in q and not any(k.startswith("op1") for k in q), sorted(q)
assert set(e.oracle_sql()) <= set(q)
"""
    for gone in ("corpus_pipeline", "winnowry.llm", "ahocorasick", "sentencepiece"):
        subprocess.run([sys.executable, "-c", code, gone], cwd=ROOT, check=True, timeout=120)
