"""Tasks run where the package is not installed: what they need travels with the job."""

import os
import subprocess
import sys

import __spark_entry__ as registry

CODE = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as registry
from sheafspark.session import local_session
spark = local_session(4, "elsewhere")
spark.sparkContext.setLogLevel("OFF")
for name, run in registry.queries().items():
    if name.startswith("op"):
        run(spark, {data!r}).write.format("noop").mode("overwrite").save()
        print("ran", name)
spark.stop()
"""


def test_queries_run_from_another_folder(sf_dir, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", CODE.format(root=root, data=sf_dir)], cwd=tmp_path, env=env, capture_output=True, text=True
    )
    assert done.stdout.count("ran op") == sum(n.startswith("op") for n in registry.queries()), done.stderr[-3000:]
