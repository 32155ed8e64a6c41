"""The library outside its own folder, and without the text operators."""

import os
import subprocess
import sys

from workbooks import write_workbook

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from careflow.sources import workbook
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", workbook.scan_workbooks(spark, sys.argv[1]).filter("_row_idx >= 0").count())
spark.stop()
"""


def test_workbooks_are_read_from_another_folder(tmp_path):
    """Workers that know nothing of the library get it from the driver."""
    books, elsewhere = tmp_path / "in", tmp_path / "cwd"
    books.mkdir()
    elsewhere.mkdir()
    write_workbook(books / "x.xlsx", {"甲": [["名"], ["东京"], ["大阪"]]})
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYTHONPATH", "SPARK_", "PYSPARK_SUBMIT"))}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT), str(books)],
        cwd=elsewhere, env=env, capture_output=True, text=True, timeout=200)
    assert "rows 2" in done.stdout, done.stderr[-2000:]


def test_entry_without_the_text_operators(tmp_path):
    """With the text operators deleted the entry still imports and has every other query."""
    copy = tmp_path / "repo"
    copy.mkdir()
    for name in ("careflow", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", os.path.join(ROOT, name), str(copy)], check=True)
    if (copy / "careflow" / "llm").exists():
        subprocess.run(["mv", str(copy / "careflow" / "llm"), str(tmp_path / "away")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(e.oracle_sql()) == set(q), 'pipeline' in q)"
    env = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=100)
    count, every, pipeline = done.stdout.split()
    assert int(count) >= 60 and (every, pipeline) == ("True", "False"), done.stderr[-2000:]
