"""The library and its entry work without the training-data operators."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["quire", "llm"] or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=".".join(name.split(".")[:2]))
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
names = set(e.queries())
assert "nb_predict" in names and "nb_predict" in e.oracle_sql()
assert not any(n.startswith("op1") or n == "pipeline" for n in names), names
import quire.plans.jobs, quire.streaming.scoring
assert not any(m.startswith("quire.llm") for m in sys.modules)
print("fine")
"""


def test_entry_without_the_subpackage():
    run = subprocess.run([sys.executable, "-c", CODE], cwd=REPO, capture_output=True, text=True)
    assert run.stdout.strip() == "fine", run.stderr


def test_nothing_else_imports_it():
    for folder, _, files in os.walk(os.path.join(REPO, "quire")):
        if os.path.join("quire", "llm") in folder:
            continue
        for name in files:
            if name.endswith(".py"):
                assert "quire.llm" not in open(os.path.join(folder, name)).read()
