import pytest

from hourlake.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_its_sql(spark, duck, same, name):
    df = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    same((df.columns, [tuple(r) for r in df.collect()]), duck(catalog.ORACLE[name], "sf0.001"))


def test_every_reason_occurs(spark):
    from hourlake.functions.lines import REASONS

    rows = catalog.QUERIES["reason_counts"](spark, "/root/testdata/sf0.001").collect()
    assert {r["invalid_reason"] for r in rows} == {None, *REASONS}


def test_file_inventory_counts_files(spark):
    row = catalog.QUERIES["file_inventory"](spark, "/root/testdata/sf0.001").first()
    assert row["files"] == 14 and row["total_bytes"] > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_scans_are_pruned(spark):
    """A query of Silver reads only the columns of events that make lines, and joins the dimension without a shuffle."""
    df = catalog.QUERIES["row_count"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
