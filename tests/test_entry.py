import ast
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


def test_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    for n in (1, 2, 3, 4):
        assert f"p{n}_found" in e.queries()


def test_nothing_outside_imports_the_llm_package():
    for p in ROOT.joinpath("quartzflow").rglob("*.py"):
        if "llm" in p.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), p


def test_flagship(spark):
    if not Path("/root/testdata/sf0.001").exists():
        pytest.skip("no test tables")
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["base_account", "window_days", "peak_day"] and df.count() > 0
