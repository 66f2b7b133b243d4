"""The training-data subpackage is optional, and nothing else needs it."""

import os
import re
import subprocess
import sys

from conftest import ROOT

BLOCK = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
print(sum(n.startswith("op") for n in e.queries()), len(e.queries()) > 50, "clean_catalog" in e.oracle_sql())
"""


def run(*names):
    return subprocess.run([sys.executable, "-c", BLOCK.format(names=names)], cwd=ROOT, capture_output=True, text=True, timeout=120)


def test_entry_works_without_the_subpackage():
    for names in (("folio.llm",), ("folio.llm.queries",), ("corpus_pipeline",)):
        assert run(*names).stdout.split() == ["0", "True", "True"]


def test_other_missing_modules_are_not_hidden():
    if os.path.isdir(os.path.join(ROOT, "folio", "llm")):
        got = run("pyarrow")
        assert got.returncode and "pyarrow" in got.stderr


def test_nothing_else_imports_the_subpackage():
    for top, _, files in os.walk(os.path.join(ROOT, "folio")):
        if os.path.basename(top) != "llm":
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(top, f), encoding="utf-8") as src:
                        assert not re.search(r"folio\.llm|corpus_pipeline", src.read()), f
