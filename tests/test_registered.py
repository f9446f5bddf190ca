"""Every registered query against its SQL counterpart, over the whole tables."""

import subprocess
import sys
from pathlib import Path

import compare
import pytest

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, con, name):
    names, rows = compare.spark_rows(QUERIES[name](spark, small))
    assert rows, "no rows"
    if name in ORACLE:
        wanted_names, wanted = compare.sql_rows(con, ORACLE[name])
        assert names == wanted_names
        assert rows == wanted


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 1186


BLOCKED = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {blocked!r} or name in {blocked!r}:
            raise ImportError(name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
names, sql = set(entry.queries()), set(entry.oracle_sql())
assert sql <= names and "train_dataset" in names
print(sum(n.startswith("op") or n == "pipeline" for n in names))
"""


@pytest.mark.parametrize("blocked, texts", [(["xxhash"], 0), (["marquee.llm"], 0), (["corpus_pipeline"], 13)])
def test_the_rest_is_registered_without_what_cannot_be_imported(blocked, texts):
    """A missing library or folder takes the text operators or their pipeline away, and nothing else."""
    run = subprocess.run(
        [sys.executable, "-c", BLOCKED.format(blocked=blocked)], cwd=Path(entry.__file__).parent, capture_output=True, text=True, check=True
    )
    assert int(run.stdout) in (0, texts)
