"""Hot-entity panels: the range-split scan and the skew-safe history
operators against plain entity windows.

The panel is the orders table with one customer owning a third of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelspark.operators import history as H
from panelspark.operators.ordered import entity_scan
from panelspark.spec import PanelSpec

SP = PanelSpec()


@pytest.fixture(scope="module")
def hot(spark):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    return o.select(
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderdate").cast("timestamp").alias("s_2"),
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderkey") % 5 == 0, None).otherwise(F.col("o_totalprice")).alias("x"),
        F.when(F.col("o_orderkey") % 7 < 3, None).otherwise(F.col("o_orderpriority")).alias("s"))


def _same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("parts", [8, 29])
def test_scan_matches_windows(spark, hot, parts):
    out = entity_scan(hot, SP, lag={"lx": "x", "ls": "s", "lq": "seq"}, ffill={"fx": "x", "fs": "s"},
                      count_nonnull={"nx": "x"}, row_number="rn", n_parts=parts)
    w = SP.window()
    wu = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ref = hot.select("seq", F.lag("x").over(w).alias("lx"), F.lag("s").over(w).alias("ls"), F.lag("seq").over(w).alias("lq"),
                     F.last("x", True).over(wu).alias("fx"), F.last("s", True).over(wu).alias("fs"),
                     F.count("x").over(wu).alias("nx"), F.row_number().over(w).cast("long").alias("rn"))
    _same(out.select("seq", "lx", "ls", "lq", "fx", "fs", "nx", "rn"), ref)


def test_hot_entity_spans_partitions(spark, hot):
    """The range bounds include the order key: the hot entity is cut over
    many partitions (a plain window would hold it in one task)."""
    keys = [F.col("customer_id"), SP.order_key()]
    spread = (hot.repartitionByRange(16, *keys).select("customer_id", F.spark_partition_id().alias("p"))
              .where("customer_id = -1").select("p").distinct().count())
    assert spread >= 4


def test_scan_reads_pinned_pieces(spark, hot):
    """The rows come from the pinned windows over pieces; only the edge table has a window over entities."""
    out = entity_scan(hot, SP, ffill={"fx": "x"})
    rows_branch = out._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    assert "ExistingRDD" in rows_branch
    assert "Window [" not in rows_branch and "Exchange" not in rows_branch


def test_scan_keeps_values_and_types(spark):
    """NaN, far timestamps, exact longs and NULLs are what a window gives, whatever the pieces."""
    rows = [("a" if i % 3 else None, f"{2000 + i % 8000}-12-31 23:59:59", i, float("nan") if i % 4 == 0 else float(i) if i % 4 < 3 else None, 2**62 + i if i % 5 else None)
            for i in range(1, 400)] + [("a", None, 1000, 1.0, None)]
    df = spark.createDataFrame(rows, "customer_id string, s_2 string, seq long, x double, big long").withColumn("s_2", F.col("s_2").cast("timestamp"))
    out = entity_scan(df, SP, lag={"lx": "x", "lb": "big"}, ffill={"fx": "x", "fb": "big"}, count_nonnull={"nx": "x"}, row_number="rn", n_parts=13)
    assert out.schema["lb"].dataType.simpleString() == "bigint" and out.columns == [*df.columns, "lx", "lb", "fx", "fb", "nx", "rn"]
    w = SP.window()
    wu = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ref = df.select("*", F.lag("x").over(w).alias("lx"), F.lag("big").over(w).alias("lb"), F.last("x", True).over(wu).alias("fx"),
                    F.last("big", True).over(wu).alias("fb"), F.count("x").over(wu).alias("nx"), F.row_number().over(w).cast("long").alias("rn"))
    _same(out, ref)


def test_history_ops_on_hot_entity(spark, hot):
    w = SP.window()
    wu = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    _same(H.lag_diff(hot, SP, ["x"]).select("seq", "x_diff"),
          hot.select("seq", (F.col("x") - F.lag("x").over(w)).alias("x_diff")))
    _same(H.ffill(hot, SP, ["x", "s"]).select("seq", "x", "s"),
          hot.select("seq", F.last("x", True).over(wu).alias("x"), F.last("s", True).over(wu).alias("s")))
    _same(H.leading_null_flags(hot, SP, ["s"]).select("seq", "s_leading_null"),
          hot.select("seq", (F.count("s").over(wu) == 0).alias("s_leading_null")))
    r = F.dense_rank().over(Window.partitionBy("customer_id").orderBy(F.col("s_2").desc()))
    _same(H.except_last(hot, SP, 2).select("seq"), hot.withColumn("r", r).where("r > 2").select("seq"))
    _same(H.days_ago(hot, SP).select("seq", "days_ago"),
          hot.select("seq", F.datediff(F.max("s_2").over(SP.whole()), F.col("s_2")).alias("days_ago")))


def test_char_counts_without_documents(spark, hot):
    """Row-based character counts equal the counts of the joined document."""
    from panelspark.operators import encode as E
    docs = E.category_documents(hot, SP, ["s"])
    a = E.document_char_counts(hot, SP, "s").select("customer_id", "ch", "tf")
    b = E._char_counts(docs, "customer_id", "s_doc").select("customer_id", "ch", "tf")
    _same(a, b)


def test_large_dictionary_codes(spark, hot):
    """Codes from the two-level running sum equal ranks inside each feature."""
    from panelspark.operators import encode as E
    d = hot.select(F.lit("f").alias("feature"), F.col("seq").cast("string").alias("value")).distinct().unionByName(
        hot.select(F.lit("g").alias("feature"), F.col("s").alias("value")).where("value IS NOT NULL").distinct())
    a = E.number_dictionary(d).select("feature", "value", "code")
    b = d.select("feature", "value", (F.dense_rank().over(Window.partitionBy("feature").orderBy("value")) - 1).cast("int").alias("code"))
    _same(a, b)


def test_scan_null_and_string_entities(spark):
    """NULL entities form one group (window semantics); string keys work."""
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    df = o.select(F.when(F.col("o_orderkey") % 4 == 0, F.lit(None)).when(F.col("o_orderkey") % 4 == 1, F.lit("hot"))
                  .otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
                  F.col("o_orderdate").cast("timestamp").alias("s_2"), F.col("o_orderkey").alias("seq"),
                  F.when(F.col("o_orderkey") % 5 == 0, None).otherwise(F.col("o_totalprice")).alias("x"))
    out = entity_scan(df, SP, lag={"lx": "x"}, ffill={"fx": "x"}, count_nonnull={"nx": "x"}, row_number="rn", n_parts=23)
    w = SP.window()
    wu = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ref = df.select("seq", F.lag("x").over(w).alias("lx"), F.last("x", True).over(wu).alias("fx"),
                    F.count("x").over(wu).alias("nx"), F.row_number().over(w).cast("long").alias("rn"))
    _same(out.select("seq", "lx", "fx", "nx", "rn"), ref)


def _skew_marks(spark, df):
    """How many joins AQE split, with small thresholds and broadcast off."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = df()
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().count("skew=true")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_per_entity_join_is_split(spark, hot):
    """A hot entity's rows are split when its aggregate is joined back, also below a groupBy(entity)."""
    many = hot.repartition(16)  # rows of one map task are never split
    assert _skew_marks(spark, lambda: H.last_broadcast(many, SP)) > 0
    assert _skew_marks(spark, lambda: H.months_ago(many, SP)) > 0
    assert _skew_marks(spark, lambda: H.months_ago(many, SP).groupBy("customer_id").agg(F.max("months_ago"))) > 0


def test_every_whole_history_join_is_split(spark, hot):
    """Sequences, the cut of except_last and group statistics are joined back by ``join_small`` too."""
    from panelspark.operators import features as FT
    from panelspark.operators import sequences as Q
    many = hot.repartition(16)
    spec = SP.with_(num=("x",), cat=("s",))
    assert _skew_marks(spark, lambda: Q.sequence_v2(many, spec)) > 0
    assert _skew_marks(spark, lambda: Q.sequence_v1(many, spec)) > 0
    assert _skew_marks(spark, lambda: H.except_last(many, spec, 1)) > 0
    assert _skew_marks(spark, lambda: FT.group_rel_transform(many.withColumn("hot", F.col("customer_id") == -1), spec, "hot", "h", ["x"])) > 0


def test_flattened_history_is_reduced_before_it_is_collected(spark, hot):
    """At most max_periods structs of an entity meet in one buffer: the (entity, period) aggregate lies below."""
    from panelspark.operators import features as FT
    spec = SP.with_(num=("x",), cat=("s",))
    plan = FT.flatten_full_history(hot, spec)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("collect_list") < plan.index("max_by")
    p = H.months_ago(hot, spec, "ago").where("ago < 13")
    last = p.withColumn("k", F.row_number().over(Window.partitionBy("customer_id", "ago").orderBy(F.desc("s_2"), F.desc("seq")))).where("k = 1")
    want = {(r.customer_id, r.ago): (-1.0 if r.x is None else float(r.x), "-1" if r.s is None else r.s) for r in last.collect()}
    for r in FT.flatten_full_history(hot, spec).collect():
        for i in range(13):
            x, s = want.get((r.customer_id, i), (-1.0, "-1"))
            assert (float(r[f"x_{i}"]), r[f"s_{i}"]) == (x, s)


def test_text_categories_in_sequence_v1(spark):
    """Text categories become ordinal codes; the sentinels stay what they are for numbers."""
    from panelspark.operators import sequences as Q
    rows = [(1, "2020-01-05", 1, None, None), (1, "2020-02-05", 2, 2.5, "F"), (1, "2020-04-05", 3, None, None), (2, "2020-04-01", 4, 1.0, "M")]
    df = spark.createDataFrame(rows, "customer_id long, s_2 string, seq long, x double, sex string").withColumn("s_2", F.col("s_2").cast("timestamp"))
    got = {r.customer_id: r.seq for r in Q.sequence_v1(df, SP.with_(num=("x",), cat=("sex",), max_periods=4)).collect()}
    assert got == {1: [[-2.0, -2.0], [0.0, 2.5], [-3.0, -3.0], [-1.0, -1.0]], 2: [[-3.0, -3.0]] * 3 + [[1.0, 1.0]]}


def test_apply_panel_is_bounded_on_a_hot_entity(spark, hot):
    """The function sees at most max_periods rows, in order, and the history is cut below the exchange."""
    def see(pdf):
        import pandas as pd
        return pd.DataFrame({"customer_id": [pdf["customer_id"].iloc[0]], "n": [len(pdf)], "seqs": [",".join(map(str, pdf["seq"]))]})

    rows = hot.select("customer_id", "s_2", "seq")
    out = H.apply_panel(rows, SP, see, "customer_id long, n long, seqs string")
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    got = {r.customer_id: r.seqs for r in out.collect()}
    r = F.row_number().over(SP.window(desc=True))
    last = rows.withColumn("r", r).where("r <= 13").orderBy("s_2", "seq").collect()
    want = {}
    for x in last:
        want.setdefault(x.customer_id, []).append(str(x.seq))
    assert got == {k: ",".join(v) for k, v in want.items()} and len(want[-1]) == 13


@pytest.mark.parametrize("batch", [3, 10000])
def test_apply_panel_gives_python_many_entities_at_once(spark, batch):
    """Entities share the batches, over whose ends they may reach; each frame has the types of its own rows, whatever its neighbours hold."""
    big = 2**60 + 1
    rows = [(k, f"2020-01-{1 + (i * 7) % 28:02d}", i, None if (k, i) == (3, 2) else big + i, None if (k, i) == (2, 1) else i % 2 == 0)
            for k in [*range(40), None] for i in range(5)] + [(7, None, 9, big, True), (7, None, 8, big, True)]
    df = spark.createDataFrame(rows, "customer_id long, s_2 string, seq long, x long, b boolean").withColumn("s_2", F.col("s_2").cast("timestamp"))

    def see(pdf):
        import pandas as pd
        k = pdf["customer_id"].iloc[0]
        if k == 5:
            return pd.DataFrame()
        return pd.DataFrame([[None if pd.isna(k) else int(k), ",".join(map(str, pdf["seq"])), str(pdf["x"].dtype), str(pdf["b"].dtype), None if k == 3 else int(pdf["x"].max()), len(pdf.columns)]])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = H.apply_panel(df, SP, see, "customer_id long, seqs string, x string, b string, top long, width int", n=4)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r.customer_id: r for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "FlatMapGroupsInPandas" not in plan and "WindowGroupLimit" in plan
    assert set(got) == {*range(40), None} - {5}
    for k, r in got.items():
        mine = [x for x in rows if x[0] == k]
        last = sorted((x for x in mine if x[1]), key=lambda x: (x[1], x[2]))[-4:]
        assert r.seqs == ",".join(str(x[2]) for x in last) and r.width == 5
        assert (r.x, r.b) == ("float64" if any(x[3] is None for x in last) else "int64", "object" if any(x[4] is None for x in last) else "bool")
        assert r.top == (None if k == 3 else max(x[3] for x in last))


def test_document_chunks_of_a_hot_entity(spark, hot, tmp_path):
    """The chunks joined are the document; a hot entity's document is made of many, and the sink keeps their order."""
    from panelspark.operators import encode as E
    from panelspark.sources import io
    want = {r.customer_id: r.s_doc for r in E.category_documents(hot, SP, ["s"]).collect()}
    chunks = E.document_chunks(hot, SP, "s", rows=100)
    assert chunks.where("customer_id = -1").count() == -(-hot.where("customer_id = -1").count() // 100)
    io.sink_documents(chunks, str(tmp_path / "docs"), "customer_id")
    got = {}
    for r in spark.read.parquet(str(tmp_path / "docs")).orderBy("customer_id", "chunk").collect():
        got[r.customer_id] = f"{got[r.customer_id]} {r.text}" if r.customer_id in got else r.text
    assert got == want


def test_pin_runs_its_plan_once(spark):
    from panelspark.operators.ordered import pin
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    out = pin(spark.range(1000).mapInArrow(count, "id long"))
    assert out.count() == 1000 and seen.value == 1000
