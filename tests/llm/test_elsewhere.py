"""The queries run where the tasks cannot import the package."""

import os
import subprocess
import sys

import __spark_entry__ as entry

CODE = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as e
from stocktide.session import build_session
spark = build_session("elsewhere", cores=2, memory="3g")
spark.sparkContext.setLogLevel("ERROR")
try:
    spark.range(1).mapInArrow(lambda batches: (b for b in batches if __import__("stocktide")), "id long").collect()
    sys.exit("the tasks can import the package, so this test says nothing")
except Exception as error:
    assert "stocktide" in str(error), error
for name in sys.argv[3:]:
    e.queries()[name](spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
    print("ran", name)
"""


def test_all_queries_run_without_the_package_on_executors(folder, tmp_path):
    names = sorted(n for n in entry.queries() if n.startswith("op")) + ["pipeline", "i20_seasonal_arima"]
    clean = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    done = subprocess.run([sys.executable, "-c", CODE, os.path.dirname(entry.__file__), folder, *names], cwd=tmp_path, env=clean, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[1] for line in done.stdout.splitlines() if line.startswith("ran ")] == names
