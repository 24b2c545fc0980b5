"""The driver's entry points."""

import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"
# One cheap query per module; all of them are compared by `python -m checks.compare`.
SAMPLE = ["cln_fuel", "dd_key_last", "prc_publish", "dic_power", "ftr_group_rare", "ci_compare", "enr_pricemed", "ext_key_colon_value", "brz_key_distinct", "ml_metrics"]


def test_every_sql_has_a_query():
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) > 100
    queries = {n: q for n, q in queries.items() if not re.match(r"op\d|pipeline$", n)}
    oracle = {n: q for n, q in oracle.items() if n in queries}
    assert set(queries) == set(oracle)


@pytest.mark.parametrize("dropped", [["tasador/llm", "tests/llm"], ["tasador/llm", "tests/llm", "corpus_pipeline.py"]])
def test_without_text_operators(tmp_path, dropped):
    """The rest of the queries register, and the rest of the modules import, where the text folders are gone."""
    root, copy = Path(__file__).resolve().parent.parent, tmp_path / "repo"
    shutil.copytree(root, copy, ignore=lambda folder, names: [n for n in names if str(Path(folder, n).relative_to(root)) in dropped or n in (".git", "__pycache__")])
    assert not (copy / "tasador/llm").exists()
    own = [n for n in entry.queries() if not re.match(r"op\d|pipeline$", n)]
    code = "import bench, checks.compare, __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    names, sql = done.stdout.splitlines()[-2:]
    assert names.split() == sorted(own) and set(sql.split()) <= set(own)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_same_as_sql(spark, name):
    ok, note = compare(spark, connect(SF), SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, note
