import re
from pathlib import Path

import __spark_entry__ as entry


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 180
    if (Path(entry.__file__).parent / "millrace" / "llm" / "__init__.py").exists():
        assert {f"op{i}" for i in range(1, 14)} | {"pipeline"} == {n.split("_")[0] for n in entry.queries() if re.match(r"op\d+_|pipeline$", n)}


def test_entry_runs(spark):
    assert {r.style_id for r in entry.entry(spark).collect()} == {"de", "en", "es", "fr"}
