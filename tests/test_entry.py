import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_entry(spark, sf):
    assert entry.entry(spark).count() > 0


def test_oracles_are_of_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_needs_the_training_data_operators():
    code = (
        "import sys\n"
        "class No:\n"
        "    def find_spec(self, name, *_):\n"
        "        if name == 'corpus_pipeline' or name.startswith('tessera.llm'):\n"
        "            raise ImportError(name)\n"
        "sys.meta_path.insert(0, No())\n"
        "import __spark_entry__ as e, pkgutil, importlib, tessera\n"
        "for m in pkgutil.walk_packages(tessera.__path__, 'tessera.', onerror=lambda n: None):\n"
        "    if not m.name.startswith('tessera.llm'):\n"
        "        importlib.import_module(m.name)\n"
        "assert len(e.queries()) > 50 and 'pipeline' not in e.queries()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
