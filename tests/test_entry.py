"""The driver's entry point imports anywhere."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import glob, zipfile
glob.glob = lambda *a, **k: []
def closed(*a, **k):
    raise AssertionError("a jar was opened")
zipfile.ZipFile = closed
import __spark_entry__ as e
from pyspark.sql import SparkSession
sql = e.oracle_sql()
assert sql and set(sql) <= set(e.queries()), set(sql) - set(e.queries())
assert SparkSession.getActiveSession() is None
print("imported", len(sql))
"""


def test_import_needs_no_jar_and_no_session(tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("SPARK_HOME", "JAVA_HOME")}
    env |= {"PYTHONPATH": ROOT, "PATH": "/nonexistent"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.startswith("imported")


def test_stop_words_match_the_public_lists(spark):
    from panelflow.functions.text import default_stop_words
    from pyspark.ml.feature import StopWordsRemover

    lists = [StopWordsRemover.loadDefaultStopWords(x) for x in ("english", "spanish")]
    assert set(default_stop_words()) == {w for words in lists for w in words}
