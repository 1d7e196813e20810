"""The entry file without its optional parts."""

import subprocess
import sys
import textwrap
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


def run(code: str) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=ROOT, capture_output=True, text=True)


def test_queries_without_the_optional_parts():
    out = run("""
        import sys

        class Absent:
            def find_spec(self, name, path=None, target=None):
                if name in ("earworm.llm", "corpus_pipeline"):
                    raise ModuleNotFoundError(name=name)

        sys.meta_path.insert(0, Absent())
        import __spark_entry__ as e
        keys = set(e.queries())
        assert "popularity_map" in keys and "pipeline" not in keys and not any(k.startswith("op") for k in keys)
        assert set(e.oracle_sql()) <= keys
    """)
    assert out.returncode == 0, out.stderr


@pytest.mark.parametrize("name", ["numpy", "earworm.session"])
def test_other_import_errors_are_not_hidden(name):
    out = run(f"""
        import sys

        class Absent:
            def find_spec(self, module, path=None, target=None):
                if module == {name!r}:
                    raise ModuleNotFoundError(name=module)

        sys.meta_path.insert(0, Absent())
        import __spark_entry__ as e
        e._optional("earworm.session", "build_session", ("earworm.llm",))
        import numpy
    """)
    assert out.returncode != 0 and "ModuleNotFoundError" in out.stderr
