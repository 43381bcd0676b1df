"""The driver's contract holds with and without the corpus operators."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

HIDDEN = """
import importlib.abc, sys
class Hide(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == "lodestrata.llm" or name.startswith("lodestrata.llm."):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Hide())
"""

LOOK = """
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert set(o) <= set(q) and "repurposing_verdict" in q
print(sorted(k for k in q if k == "pipeline" or k.startswith("op") and k[2:3].isdigit()))
"""


def _run(code):
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.strip()


def test_without_the_corpus_operators():
    assert _run(HIDDEN + LOOK) == "[]"


def test_an_import_error_inside_a_module_is_not_swallowed(tmp_path):
    (tmp_path / "broken.py").write_text("import nothing_of_this_name")
    code = f"import sys; sys.path.insert(0, {str(tmp_path)!r})\nimport __spark_entry__ as e\ntry:\n    e._optional('broken')\nexcept ModuleNotFoundError as x:\n    print(x.name)\nprint(e._optional('not_there'))"
    assert _run(code).split() == ["nothing_of_this_name", "None"]
