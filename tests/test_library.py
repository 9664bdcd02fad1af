"""What the library's source may and may not use."""

from pathlib import Path

import pytest

PACKAGE = Path(__file__).resolve().parents[1] / "ledgerloom"
SOURCES = {path.relative_to(PACKAGE).as_posix(): path.read_text() for path in PACKAGE.rglob("*.py")}
SOURCES = {name: text for name, text in SOURCES.items() if not name.startswith("llm/")}

# Dictionary rows: bounded by the number of columns. Cells of a key: by the number of parts that are planned.
MAY_COLLECT = {"sources/dictionary.py": 1, "sources/predicates.py": 2}


def _calls(text, name):
    return text.count(f".{name}(")


@pytest.mark.parametrize("name", sorted(SOURCES))
def test_rows_stay_on_executors(name):
    text = SOURCES[name]
    assert _calls(text, "collect") == MAY_COLLECT.get(name, 0)
    assert "defaultParallelism" not in text
    for method in ("toPandas", "toLocalIterator", "take", "head", "tail", "localCheckpoint", "crossJoin"):
        assert _calls(text, method) == 0


@pytest.mark.parametrize("name", sorted(SOURCES))
def test_work_stays_in_built_in_operators(name):
    for word in ("udf", "applyInPandas", "mapInPandas", "mapPartitions", "import pandas", "import numpy"):
        assert word not in SOURCES[name]
