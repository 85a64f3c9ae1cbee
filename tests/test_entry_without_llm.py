"""The entry imports and runs its other queries when the training-data folders are gone."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
import __spark_entry__ as E
from corvid.session import get_spark
found = E.queries()
assert "op1_line_dedup" not in found and "pipeline" not in found and "op1_line_dedup" not in E.oracle_sql()
spark = get_spark("local[2]", shuffle_partitions=2)
print("ROWS", found["group_count"](spark, E.SMOKE_DIR).count())
"""


@pytest.mark.parametrize("pipeline_kept", [True, False])
def test_entry_without_the_subpackage(tmp_path, pipeline_kept):
    home = tmp_path / "copy"
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "tests", *([] if pipeline_kept else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, home, ignore=skip)
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=home, capture_output=True, text=True, timeout=300,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0, done.stderr[-2000:]
    assert "ROWS" in done.stdout
