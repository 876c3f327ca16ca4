"""Driver contract: entry() runs, and every query has a matching oracle."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from parcelwise.oracle import ORACLE_SQL
from parcelwise.queries import QUERIES

FAST = ["period_ranges", "assign_partition_orders", "slice_partition_events", "pending_partitions",
        "uncovered_rows_orders", "selection_list", "related_closure", "invalid_specs",
        "overlapping_ranges_orders", "run_precedence", "rematerialize_after_empty", "unknown_tables"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["table_name", "partition_name", "n_rows", "min_date", "max_date"]
    assert len(rows) == 27


def test_every_query_has_an_oracle():
    """Those of the partition toolkit; the optional corpus queries come on top."""
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_the_entry_works_without_the_corpus_operators():
    """The rest imports and registers its queries when the optional parts cannot be imported."""
    code = ("import sys; sys.modules['parcelwise.llm'] = None; sys.modules['corpus_pipeline'] = None; "
            "import __spark_entry__ as e; from parcelwise.queries import QUERIES; assert set(e.queries()) == set(QUERIES)")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(E.__file__))


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_small(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = E.queries()[name](spark, sf_small)
    cols = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = {c: i for i, c in enumerate(dcols)}
    want = sorted(tuple(str(r[idx[c]]) for c in cols) for r in rel.fetchall())
    assert got == want
