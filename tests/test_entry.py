import ast
import pathlib

import __spark_entry__ as entry
from tidemark.plans import round_trips
from tidemark.plans.oracle import ORACLE
from tidemark.plans.queries import QUERIES

ROOT = pathlib.Path(entry.__file__).parent


def test_every_query_has_sql_but_for_outlines():
    assert set(QUERIES) - set(ORACLE) == {"cluster_outline", "geojson_export"}  # their shapes and properties have
    assert set(round_trips.QUERIES) <= set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_imports_the_corpus_subpackage():
    for path in (ROOT / "tidemark").rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith("tidemark.llm") or n == "corpus_pipeline" for n in names), path


def test_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "draught_arrival" in df.columns
