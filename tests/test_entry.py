"""The rest registers its queries also where the optional parts are missing."""

import importlib
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("hidden", [["ticketlens.llm"], ["ticketlens.llm", "corpus_pipeline"]])
def test_optional_parts_may_be_missing(hidden):
    """In a process of its own, where the hidden modules cannot be found."""
    code = f"""
import importlib.abc, sys
class Hide(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if any(name == h or name.startswith(h + ".") for h in {hidden!r}):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as entry
names = entry.queries()
assert "status_trust" in names and not any(n.startswith("op") for n in names), sorted(names)
assert "pipeline" not in names and set(entry.oracle_sql()) <= set(names)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_other_missing_modules_are_errors(monkeypatch):
    real = importlib.import_module

    def broken(name):
        if name == entry.OPTIONAL[0]:
            raise ModuleNotFoundError("No module named 'numpy'", name="numpy")
        return real(name)

    monkeypatch.setattr(entry, "import_module", broken)
    with pytest.raises(ModuleNotFoundError):
        entry.queries()
