import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).parent.parent
ASK = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), len(s), sorted(n for n in q if n[:2] == 'op' or n == 'pipeline'))"


@pytest.mark.parametrize("pipeline_too", [True, False])
def test_queries_without_the_training_data_folders(tmp_path, pipeline_too):
    """The folders of the training-data operators may be gone, with the pipeline still there or gone with them."""
    left_out = shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if pipeline_too else ["corpus_pipeline.py"]))
    shutil.copytree(REPO, tmp_path / "repo", ignore=left_out)
    said = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    queries, sql, others = said.stdout.split(" ", 2)
    assert int(queries) >= 88 and int(sql) >= 88 and others.strip() == "[]"
