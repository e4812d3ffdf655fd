import importlib
import sys


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_works_without_the_optional_folders(monkeypatch):
    for name in ("tidemark.llm", "tidemark.llm.queries", "corpus_pipeline"):
        monkeypatch.setitem(sys.modules, name, None)  # as if its file weren't there
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    entry = importlib.import_module("__spark_entry__")
    try:
        assert "D2_universe_range" in entry.queries() and not any(n.startswith(("op", "pipeline")) for n in entry.queries())
    finally:
        sys.modules.pop("__spark_entry__", None)


def test_nothing_else_imports_the_optional_folder():
    from pathlib import Path

    root = Path(__file__).resolve().parents[1] / "tidemark"
    users = [p for p in root.rglob("*.py") if "llm" not in p.parts and "tidemark.llm" in p.read_text()]
    assert not users
