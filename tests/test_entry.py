import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_rest_works_without_the_training_operators(tmp_path):
    """The folder may be deleted with corpus_pipeline.py."""
    for name in os.listdir(ROOT):
        if name not in ("scriptorium", "corpus_pipeline.py", ".git", "tests"):
            os.symlink(f"{ROOT}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "scriptorium")
    for name in os.listdir(f"{ROOT}/scriptorium"):
        if name != "llm":
            os.symlink(f"{ROOT}/scriptorium/{name}", tmp_path / "scriptorium" / name)
    code = "import sys; sys.path.insert(0, '.'); import __spark_entry__ as e; q = e.queries(); assert q and not [n for n in q if n.startswith('op') and n[2].isdigit()] and 'pipeline' not in q; e.oracle_sql()"
    text = open(f"{ROOT}/__spark_entry__.py").read()
    os.remove(tmp_path / "__spark_entry__.py")
    (tmp_path / "__spark_entry__.py").write_text(text)
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_queries_run_from_another_folder(tmp_path):
    """Workers find the package wherever the driver was started."""
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert e.queries()["duplicate_guard"](s, "/root/testdata/sf0.001").count() > 0
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
