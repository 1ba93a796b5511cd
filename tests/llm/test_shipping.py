"""Workers without the package, and the catalog without what it imports."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]


def run(code: str, folder) -> str:
    """Run code in a process whose path, not that of its workers, has the repository."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    told = subprocess.run(
        [sys.executable, "-c", f"import sys; sys.path.insert(0, {str(ROOT)!r})\n{code}"], cwd=folder, env=env, capture_output=True, text=True, timeout=900
    )
    assert told.returncode == 0, told.stderr[-3000:]
    return told.stdout


def test_workers_need_no_copy_of_the_package(tmp_path):
    names = ["op5_simhash", "op8_decontamination", "op10_suffix_array", "op11_token_files", "op12_ranked_search", "op13_token_alignment"]
    code = f"""
from stayline.session import local_session
from __spark_entry__ import queries
spark = local_session(4, shuffle_partitions=4)
for name in {names!r}:
    print(name, len(queries()[name](spark, "/root/testdata/sf0.001").collect()))
"""
    found = dict(line.split() for line in run(code, tmp_path).splitlines())
    assert found["op10_suffix_array"] == found["op11_token_files"] == found["op13_token_alignment"] == "200"
    assert set(found) == set(names)


@pytest.mark.parametrize("absent", ["xxhash", "tokenizers", "corpus_pipeline"])
def test_other_queries_stay_where_an_import_fails(tmp_path, absent):
    code = f"""
sys.modules[{absent!r}] = None
from __spark_entry__ import oracle_sql, queries
print(len(queries()), len(oracle_sql()), sum(n.startswith("op") and n[2].isdigit() for n in queries()))
"""
    queries, statements, ours = map(int, run(code, tmp_path).split())
    assert queries > 200 and statements > 190
    # libraries that only tasks import are not missed here
    assert ours == (13 if absent == "tokenizers" else 0)
