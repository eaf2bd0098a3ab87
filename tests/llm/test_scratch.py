"""Scratch tables: one folder and one database of the application, and both go."""

import os

from panelspark.llm.common import Scratch, clear_scratch, scratch_places


def test_tables_lie_together_and_are_cleared(spark):
    s = Scratch(spark)
    df = spark.range(10).selectExpr("id", "id % 3 AS k")
    assert s.write(df, "rows").count() == 10 and s.write_bucketed(df, "rows", "k").count() == 10
    root, database = scratch_places(spark)
    assert all(p.startswith(f"{root}/") for p in s.paths) and len(s.tables) == 1
    assert not [t for t in spark.catalog.listTables("default") if t.name.startswith("rows_")]
    s.drop()
    assert not any(os.path.exists(p.removeprefix("file:")) for p in s.paths)
    again = Scratch(spark)
    again.write_bucketed(df, "more", "k")
    clear_scratch(spark)
    assert not os.path.exists(root.removeprefix("file:")) and not spark.catalog.databaseExists(database)
    assert Scratch(spark).write_bucketed(df, "more", "k").count() == 10
