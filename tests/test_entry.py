"""The entry module stands without the document operators and without what these import."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def listed(block: str) -> tuple[list[str], list[str]]:
    code = f"import sys; sys.modules[{block!r}] = None; {LIST}"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return json.loads(done.stdout.splitlines()[-1])


@pytest.mark.parametrize("block", ["flowsight.llm", "corpus_pipeline", "public_tokenizers", "xxhash", "regex"])
def test_other_queries_stay(block):
    queries, sql = listed(block)
    assert "flow_features" in queries and "flow_features" in sql
    if block != "regex":
        assert not [q for q in queries if q == "pipeline" or q.startswith("op1")]
