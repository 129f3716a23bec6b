"""The driver's entry points in processes of their own."""

import os
import subprocess
import sys

import pytest

from conftest import ROOT


def run(code, folder, **env):
    """Output of ``code`` in a new process whose Spark finds no settings and works in ``folder``."""
    conf = os.path.join(folder, "conf")
    os.makedirs(conf, exist_ok=True)
    env = os.environ | {"SPARK_CONF_DIR": conf, "PYTHONPATH": ROOT, "TMPDIR": str(folder)} | env
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout


def test_a_plain_session_without_checkpoint_folder(tmp_path):
    code = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
import __spark_entry__ as driver
from starloom.session import shared_folder
assert shared_folder(spark) == shared_folder(spark)
print(driver.entry(spark).count(), driver.queries()["bronze_sales"](spark, driver.FLAGSHIP_DATA).count())
"""
    assert run(code, str(tmp_path)).split() == ["42", "6000"]


@pytest.mark.parametrize("module", ["starloom.llm", "xxhash", "numpy", "corpus_pipeline"])
def test_a_missing_module_takes_the_text_operators_alone(tmp_path, module):
    code = f"""
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {module!r}:
            raise ModuleNotFoundError("gone", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as driver
print("lakehouse_chain" in driver.queries(), any(q.startswith("op") for q in driver.queries()))
"""
    has_core, has_text = run(code, str(tmp_path)).split()
    assert has_core == "True" and (has_text == "False" or module == "xxhash")


def test_a_missing_module_of_the_core_is_an_error(tmp_path):
    code = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == "starloom.plans.fact":
            raise ModuleNotFoundError("gone", name=name)
sys.meta_path.insert(0, Missing())
try:
    import __spark_entry__
except ModuleNotFoundError as error:
    print(error.name)
"""
    assert run(code, str(tmp_path)).split() == ["starloom.plans.fact"]


def test_workers_get_the_package(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as driver
print(driver.queries()["bronze_drift"](spark, driver.FLAGSHIP_DATA).count() > 0)
"""
    assert run(code, str(tmp_path), PYTHONPATH="").split() == ["True"]
