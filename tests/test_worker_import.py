"""Python code shipped to executors must not need the package installed
there: run the Python-backed paths from a process whose workers cannot
import it (the repository is only on the driver's sys.path)."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_python_paths_without_package_on_workers(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        sys.path.insert(0, {os.path.join(REPO, 'tests')!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]")
                 .config("spark.ui.enabled", "false").getOrCreate())
        from sitelens.operators import search
        from sitelens.sources.workbook import read_workbook
        from xlsx_util import write_xlsx
        recs = spark.createDataFrame([("p1", "Zebra", "", "x")], "href string, title string, section string, text string")
        qs = spark.createDataFrame([(1, "zebra")], "query_id int, query string")
        assert search.keyword_search(qs, recs).count() == 1
        write_xlsx({str(tmp_path / 'a.xlsx')!r}, {{"S": [["a"], ["1"]]}})
        assert read_workbook(spark, {str(tmp_path)!r}).count() == 1
        print("OK")
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=300)
    assert out.returncode == 0 and "OK" in out.stdout, out.stderr[-2000:]
