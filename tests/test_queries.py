"""Every registered query against its SQL, at the smallest scale."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as driver
from checks.compare import connect, differences
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, db, name):
    if name in driver.oracle_sql():
        assert differences(spark, db, SF, driver.queries()[name], driver.oracle_sql()[name]) is None
    else:
        assert driver.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("gone", [["simmart/llm", "tests/llm"], ["simmart/llm", "tests/llm", "corpus_pipeline.py"]])
def test_the_rest_stands_without_the_training_text_operators(tmp_path, gone):
    """The entry file imports and the other tests are found without them."""
    root = Path(driver.__file__).resolve().parent
    shutil.copytree(root, tmp_path / "repo", ignore=lambda folder, names: [
        n for n in names if n in (".git", "__pycache__") or str((Path(folder) / n).relative_to(root)) in gone
    ])
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), [n for n in q if n[:2] == 'op' or n == 'pipeline'])"
    run = {"cwd": tmp_path / "repo", "capture_output": True, "text": True, "timeout": 300}
    assert subprocess.run([sys.executable, "-c", code], **run).stdout.split() == [str(len(QUERIES)), "[]"]
    found = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"], **run)
    assert found.returncode == 0 and "test_query_equals_sql" in found.stdout, found.stdout[-2000:]
