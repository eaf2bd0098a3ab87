"""The pipeline's stages against brute force over the stage's own input."""

from collections import Counter

from test_decontam import brute as windows
from test_minhash import brute as components

import corpus_pipeline as cp
from panelspark.llm.queries import table

D = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, D, "documents")
    columns, kept = docs.columns, {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, D)
        rows = out.collect()
        kept[name] = rows
        if name != "token_ids":
            assert out.columns == columns
            docs = spark.createDataFrame(rows, docs.schema)
    labels = {r.doc_id: r.toxic for r in table(spark, D, "labels").collect()}
    ids = {k: {r.doc_id for r in v} for k, v in kept.items()}
    clean = [i for i, y in labels.items() if y == 0]
    assert len([i for i in clean if i in ids["toxicity"]]) >= 0.95 * len(clean)
    first = [(r.doc_id, r.text) for r in kept["toxicity"]]
    assert ids["near_duplicates"] == {c for _, _, c in components(first, 80)}
    texts = [(r.text or "").encode() for r in kept["near_duplicates"]]
    count = Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    for before, r in zip(sorted(kept["near_duplicates"]), sorted(kept["repeated_passages"], key=lambda r: r.doc_id)):
        data, gone = before.text.encode(), set()
        for i in range(len(data) - 199):
            if count[data[i:i + 200]] > 1:
                gone.update(range(i, i + 200))
        assert r.text == bytes(b for i, b in enumerate(data) if i not in gone).decode("utf-8", "ignore") and r.n_chars == len(r.text)
    items = [(r.item_id, r.text) for r in table(spark, D, "benchmark").collect()]
    third = kept["repeated_passages"]
    assert ids["benchmark_leaks"] == {r.doc_id for r, (_, hit, _) in zip(third, windows([r.text for r in third], items)) if not hit}
    assert ids["token_ids"] == ids["benchmark_leaks"] and all(r.n_tokens == len(r.ids) for r in kept["token_ids"])


def test_run(spark):
    out = cp.run(spark, D)
    assert out.count() > 100 and "ids" in out.columns and cp.ORACLE_SQL is None


def test_stages_on_edge_rows_and_empty_tables(spark):
    """Null and empty texts, repeated rows, ties, extra columns with clashing names, and no rows at all go through every stage."""
    import random

    import corpus_pipeline
    from pyspark.sql import functions as F
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    copy, passage = text(80), text(70)
    rows = [(1, None), (2, ""), (3, copy), (4, copy), (4, copy), (5, f"{text(30)} {passage} {text(30)}"), (6, f"{text(30)} {passage} {text(30)}"), (None, text(20)), (None, None), (7, text(3000))]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("__row", "__k1", "kept", "score", "spans", "ids_", "matches"):
        docs = docs.withColumn(c, F.lit("mine"))
    d = "/root/testdata/sf0.001"
    counts = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, d)
        if name != "token_ids":
            assert out.columns == docs.columns, name
            assert out.where("kept <> 'mine'").count() == 0
        counts[name] = out.count()
        assert stage(spark, docs.limit(0), d).count() == 0, name
    assert counts.pop("toxicity") <= 10  # the labels of another table's documents: any may be rejected
    assert counts == {"near_duplicates": 8, "repeated_passages": 10, "benchmark_leaks": 10, "token_ids": 10}
