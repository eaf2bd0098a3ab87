"""Encoding, scaling and extraction operators (§2.10).

Dictionaries (category -> code, vocabulary) are DataFrames bounded by the
category domains; they are joined back with :func:`relational.join_small`
(measured before broadcast).  Statistics are one global aggregate each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import PanelSpec
from . import history as H
from .relational import join_small


# ---------------------------------------------------------------- target-like means
def category_stats(rows: DataFrame, cats, aggs: list[Column]) -> DataFrame:
    """(feature, value, aggs) of every value of all categories, in one scan and one exchange;
    written once, so that the lookups of all categories read it.  NULL is no value."""
    from .ordered import pin
    one = [F.struct(F.lit(c).alias("f"), F.col(c).cast("string").alias("v")) for c in cats]
    cells = rows.withColumn("__s", F.explode(F.array(*one))).where("__s.v IS NOT NULL")
    return pin(cells.groupBy(F.col("__s.f").alias("feature"), F.col("__s.v").alias("value")).agg(*aggs))


def lookup(df: DataFrame, stats: DataFrame, c: str, names: dict[str, str]) -> DataFrame:
    """``df`` with columns of ``stats`` (new name -> column) for its value of category ``c``; unknown -> NULL."""
    m = stats.where(F.col("feature") == c).select(F.col("value").alias("__v"), *(F.col(x).alias(n) for n, x in names.items()))
    return join_small(df.withColumn("__v", F.col(c).cast("string")), m, "__v", "left").drop("__v")


def cat_mean_last(df: DataFrame, spec: PanelSpec, cats, value: str = "p_2", keep=("dset",)) -> DataFrame:
    """encode_cat_mean_last: mean of ``value`` per category over the entities'
    last statements (all splits), mapped onto each entity's last statement.
    NULL category -> NULL."""
    last = H.tail_n(df, spec, 1)
    stats = category_stats(last, cats, [F.avg(value).alias("mean")])
    out = last.select(spec.entity, *keep, *cats)
    for c in cats:
        out = lookup(out, stats, c, {f"{c}_p2_mean": "mean"})
    return out.drop(*cats)


def cat_mean_all(df: DataFrame, spec: PanelSpec, cats, value: str = "p_2", keep=("dset",)) -> DataFrame:
    """encode_cat_mean_all: same over all statements, keyed by statement."""
    keys = [spec.entity, spec.ts] + ([spec.tiebreak] if spec.tiebreak else [])
    stats = category_stats(df, cats, [F.avg(value).alias("mean")])
    out = df.select(*keys, *keep, *cats)
    for c in cats:
        out = lookup(out, stats, c, {f"{c}_p2_mean": "mean"})
    return out.drop(*cats)


def cat_mean_flat(df: DataFrame, spec: PanelSpec, cats, value: str = "p_2") -> DataFrame:
    """encode_cat_mean_flat: last-statement category means on the 13
    months-ago flattened category columns: the last row of each period by a partial
    ``max_by``, then the lookups, then one column per period."""
    stats = category_stats(H.tail_n(df, spec, 1), cats, [F.avg(value).alias("mean")])
    rows = H.months_ago(df, spec, "__ma").where(F.col("__ma") < spec.max_periods)
    enc = rows.groupBy(spec.entity, "__ma").agg(F.max_by(F.struct(*cats), spec.order_key()).alias("__r")).select(spec.entity, "__ma", "__r.*")
    for c in cats:
        enc = lookup(enc, stats, c, {f"__m_{c}": "mean"})
    return enc.groupBy(spec.entity).agg(*[
        F.max(F.when(F.col("__ma") == i, F.col(f"__m_{c}"))).alias(f"{c}_{i}_p2_mean")
        for c in cats for i in range(spec.max_periods)])


# ---------------------------------------------------------------- ordinal / one-hot
def ordinal_dictionary(df: DataFrame, cats) -> DataFrame:
    """(feature, value, code): sorted distinct non-null values -> 0..k-1, of all categories in one scan."""
    return number_dictionary(category_stats(df, cats, [F.count(F.lit(1)).alias("__n")]).drop("__n"))


def number_dictionary(d: DataFrame) -> DataFrame:
    """code = rank of ``value`` inside ``feature`` (0-based; values distinct).

    The codes come from the two-level running sum (range partitions over
    (feature, value) + partition offsets), so no task holds a whole dictionary."""
    from .metrics import running_sums
    r = running_sums(d.withColumn("__one1", F.lit(1.0)), [F.col("value").asc()], ["__one1"], by=("feature",))
    return r.withColumn("code", (F.col("cum___one1") - 1).cast("int")).drop("__one1", "cum___one1")


def encode_ordinal(df: DataFrame, dic: DataFrame, cats, plus_one: bool = False, unseen: int | None = None, small=()) -> DataFrame:
    """encode_ordinal (unseen/NULL -> -1) or encode_ordinal_plus1 (code + 1,
    0 reserved for unseen/NULL / missing).  ``small``: categories whose dictionaries are known
    to be small; these are broadcast, so that the rows need no exchange by a value that most of them share."""
    out = df
    for c in cats:
        m = dic.where(F.col("feature") == c).select(F.col("value").alias("__v"), F.col("code").alias(f"__code_{c}"))
        rows = out.withColumn("__v", F.col(c).cast("string"))
        out = (rows.join(F.broadcast(m), "__v", "left") if c in small else join_small(rows, m, "__v", "left")).drop("__v")
        code = F.col(f"__code_{c}") + (1 if plus_one else 0)
        dflt = unseen if unseen is not None else (0 if plus_one else -1)
        out = out.withColumn(c, F.coalesce(code, F.lit(dflt)).cast("int")).drop(f"__code_{c}")
    return out


def onehot_drop_first(df: DataFrame, dic: DataFrame, cats) -> DataFrame:
    """encode_onehot_drop_first: one 0/1 column per level except the first
    (sorted); unseen and NULL -> all zeros.  The level list is collected from
    the dictionary (bounded by the category domain)."""
    levels = {}
    for r in dic.where(F.col("feature").isin(list(cats))).orderBy("feature", "code").collect():
        levels.setdefault(r["feature"], []).append(r["value"])
    cols = {}
    for c in cats:
        for v in levels.get(c, [])[1:]:
            cols[f"{c}_{v}"] = F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0))
    return df.withColumns(cols).drop(*cats)


def cat_mode(df: DataFrame, dic: DataFrame, cats, mode: str = "label") -> DataFrame:
    """cat_mode switch: 'drop' | 'label' (ordinal, unseen -1) | 'category'
    (ordinal + nominal ML attribute) | 'onehot' (drop first level)."""
    if mode == "drop":
        return df.drop(*cats)
    if mode == "onehot":
        return onehot_drop_first(df, dic, cats)
    out = encode_ordinal(df, dic, cats)
    if mode == "category":
        for c in cats:
            n = dic.where(F.col("feature") == c).count()
            meta = {"ml_attr": {"type": "nominal", "name": c, "vals": [str(i) for i in range(n)]}}
            out = out.withColumn(c, F.col(c).alias(c, metadata=meta))
    return out


# ---------------------------------------------------------------- character documents
def category_documents(df: DataFrame, spec: PanelSpec, cats) -> DataFrame:
    """agg_concat_doc for several categories: 'v1 v2 ...' in statement order,
    NULL written as 'nan' (values stringified)."""
    aggs = []
    for c in cats:
        st = F.array_sort(F.collect_list(F.struct(F.col(spec.ts), *([F.col(spec.tiebreak)] if spec.tiebreak else []),
                                                  F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("v"))))
        aggs.append(F.array_join(F.transform(st, lambda s: s["v"]), " ").alias(f"{c}_doc"))
    return df.groupBy(spec.entity).agg(*aggs)


def document_chunks(df: DataFrame, spec: PanelSpec, c: str, rows: int = 10_000) -> DataFrame:
    """agg_concat_doc in pieces: (entity, chunk, text), a chunk for each ``rows`` statements in order; the
    document is its chunks joined by a space.

    Statement numbers come from the range-split scan, so a hot entity's document is made by many
    tasks, and none holds more than a chunk.  A sink writes the chunks in order (``sink_documents``)."""
    numbered = H.entity_scan(df.select(spec.entity, spec.ts, *([spec.tiebreak] if spec.tiebreak else []), c), spec, row_number="__rn")
    v = F.struct("__rn", F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("v"))
    g = numbered.groupBy(spec.entity, F.floor((F.col("__rn") - 1) / rows).alias("chunk")).agg(F.array_sort(F.collect_list(v)).alias("__s"))
    return g.select(spec.entity, "chunk", F.array_join(F.transform("__s", lambda x: x["v"]), " ").alias("text"))


def _char_counts(docs: DataFrame, key: str, doc: str) -> DataFrame:
    return (docs.select(key, F.explode(F.split(F.lower(F.col(doc)), "")).alias("ch")).where(F.col("ch") != "")
                .groupBy(key, "ch").agg(F.count(F.lit(1)).cast("double").alias("tf")))


def document_char_counts(df: DataFrame, spec: PanelSpec, c: str) -> DataFrame:
    """Character counts of the ``category_documents`` document of ``c``
    without building it: the document is the values joined by single spaces,
    so its counts are the values' character counts plus (rows - 1) spaces.
    Values are counted per (entity, value) first (partial aggregate: a hot
    entity shrinks to its distinct values), then their characters exploded."""
    v = F.lower(F.coalesce(F.col(c).cast("string"), F.lit("nan")))
    per_val = df.groupBy(spec.entity, v.alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    chars = per_val.select(spec.entity, F.explode(F.split("__v", "")).alias("ch"), "__n").where(F.col("ch") != "")
    spaces = (per_val.groupBy(spec.entity).agg((F.sum("__n") - 1).alias("__n")).where(F.col("__n") > 0)
              .select(spec.entity, F.lit(" ").alias("ch"), "__n"))
    return (chars.unionByName(spaces).groupBy(spec.entity, "ch")
            .agg(F.sum("__n").cast("double").alias("tf")))


def char_vectors(docs: DataFrame, key: str, doc: str, tfidf: bool = False) -> DataFrame:
    """char_count_vector / char_tfidf_vector: character unigram counts with a
    sorted vocabulary (column ``{doc}_cv_{i}``), or smooth TF-IDF
    tf * (ln((1+n)/(1+df)) + 1), L2-normalised per document (``{doc}_tfidf_{i}``).

    One small job yields the vocabulary with document frequencies (bounded by
    the alphabet); the counts of a document are gathered into one map per key
    in the same aggregate that computes its norm -- no pivot, no window."""
    return char_vectors_from_counts(_char_counts(docs, key, doc), docs.select(key), key, doc, tfidf)


def char_vectors_from_counts(cnt: DataFrame, keys: DataFrame, key: str, doc: str, tfidf: bool = False) -> DataFrame:
    """``char_vectors`` from (key, ch, tf) counts; ``keys`` = one row per document."""
    voc = cnt.groupBy("ch").agg(F.count(F.lit(1)).alias("df")).orderBy("ch").collect()
    vocab = [r["ch"] for r in voc]
    tag = "tfidf" if tfidf else "cv"
    if tfidf:
        n = keys.count()
        idf = F.create_map(*[x for r in voc for x in (F.lit(r["ch"]), F.lit(math.log((1.0 + n) / (1.0 + r["df"])) + 1.0))])
        cnt = cnt.withColumn("tf", F.col("tf") * F.element_at(idf, F.col("ch")))
    m = cnt.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("ch", "tf"))).alias("__m"),
                             F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("__norm"))
    scale = F.col("__norm") if tfidf else F.lit(1.0)
    out = keys.join(m, key, "left")
    return out.select(key, *[F.coalesce(F.try_element_at(F.col("__m"), F.lit(v)) / scale, F.lit(0.0)).alias(f"{doc}_{tag}_{i}")
                             for i, v in enumerate(vocab)])


# ---------------------------------------------------------------- SVD of category history
#: Loadings are broadcast in blocks of columns of at most this size.
LOADING_BYTES = 64 << 20
#: Blocks of a Krylov basis before it is restarted from its best vectors.
KRYLOV_BLOCKS = 8


def category_indices(flat: DataFrame, key: str, cat_cols: list[str]) -> tuple[DataFrame, int]:
    """(key, __ix: the place of each column's level in the one-hot row; number of levels of all columns).

    Levels are numbered by the two-level running sum; neither their list nor a column per level
    exists anywhere.  NULL is a level."""
    from .metrics import running_sums
    from .ordered import pin
    one = [F.struct(F.lit(i).alias("c"), F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")).alias("v")) for i, c in enumerate(cat_cols)]
    cells = flat.withColumn("__row", F.monotonically_increasing_id()).select("__row", F.col(key).alias("__key"), F.explode(F.array(*one)).alias("__s"))
    cells = pin(cells.select("__row", "__key", F.col("__s.c").alias("__c"), F.col("__s.v").alias("__v")))
    levels = cells.select("__c", "__v").distinct().withColumn("__one", F.lit(1.0))
    levels = pin(running_sums(levels, [F.col("__c").asc(), F.col("__v").asc()], ["__one"]).select("__c", "__v", (F.col("cum___one") - 1).cast("int").alias("__i")))
    rows = join_small(cells, levels, ["__c", "__v"]).groupBy("__row").agg(F.first("__key").alias(key), F.sort_array(F.collect_list("__i")).alias("__ix"))
    return pin(rows.select(key, "__ix")), levels.count()


def _gram_times(rows: DataFrame, v: np.ndarray) -> np.ndarray:
    """X'X v for the one-hot X, without X'X: a task adds up x (x'v) of its rows, and the tasks' sums are added by level."""
    width, most = v.shape[0], max(1, LOADING_BYTES // (8 * max(1, v.shape[0])))
    out = np.zeros_like(v)
    for lo in range(0, v.shape[1], most):
        block = np.ascontiguousarray(v[:, lo:lo + most])
        shared = rows.sparkSession.sparkContext.broadcast(block)  # at most LOADING_BYTES, or one column

        def run(batches, n=block.shape[1]):
            load, total = shared.value, np.zeros((width, n))
            seen = False
            for b in batches:
                ix = b.column(0)
                size, flat = pc.list_value_length(ix).to_numpy(), ix.flatten().to_numpy()
                if not len(flat):
                    continue
                row, seen = np.repeat(np.arange(len(size)), size), True
                for j in range(n):
                    u = np.bincount(row, load[flat, j], len(size))
                    total[:, j] += np.bincount(flat, u[row], width)
            if seen:
                at = np.flatnonzero(total.any(axis=1))
                for i in range(0, len(at), 4096):
                    part = at[i:i + 4096]
                    yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *(pa.array(total[part, j]) for j in range(n))], names=["i", *(f"z{j}" for j in range(n))])

        names = [f"z{j}" for j in range(block.shape[1])]
        got = rows.select("__ix").mapInArrow(run, "i int, " + ", ".join(f"{c} double" for c in names)).groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
        at = got.column("i").to_numpy()
        for j, c in enumerate(names):
            out[at, lo + j] = got.column(c).to_numpy()
        shared.unpersist()
    return out


def leading_vectors(rows: DataFrame, width: int, k: int, tol: float = 1e-10, max_passes: int = 200, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, vectors) of X'X, the k largest, by a block Krylov iteration: each pass over the
    rows multiplies one block; orthogonalisation and Rayleigh-Ritz are on width x (blocks of k + 4) numbers.

    Ends when every wanted pair's residual is below ``tol`` of the largest value, or the space is exhausted."""
    k = min(k, width)
    p = min(width, k + 4)
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, p)))[0]
    basis, image = np.empty((width, 0)), np.empty((width, 0))
    for _ in range(max_passes):
        basis, image = np.hstack([basis, block]), np.hstack([image, _gram_times(rows, block)])
        small = basis.T @ image
        value, y = np.linalg.eigh((small + small.T) / 2)
        y = y[:, ::-1]
        value = value[::-1]
        top, top_image = basis @ y[:, :p], image @ y[:, :p]
        gap = np.linalg.norm(top_image[:, :k] - top[:, :k] * value[:k], axis=0)
        if (gap <= tol * max(value[0], 1e-300)).all() or basis.shape[1] >= width:
            return value[:k], top[:, :k]
        fresh = image[:, -block.shape[1]:]
        if basis.shape[1] + p > KRYLOV_BLOCKS * p:
            fresh = top_image - top * value[:top.shape[1]]
            kept = y[:, :max(1, KRYLOV_BLOCKS // 2) * p]
            basis, image = basis @ kept, image @ kept
        for _ in range(2):  # twice is enough
            fresh = fresh - basis @ (basis.T @ fresh)
        q, r = np.linalg.qr(fresh)
        block = q[:, np.abs(np.diag(r)) > 1e-12 * max(value[0], 1e-300)][:, :width - basis.shape[1]]
        block = block - basis @ (basis.T @ block)
        if not block.shape[1]:
            return value[:k], top[:, :k]
        block = np.linalg.qr(block)[0]
    raise RuntimeError(f"no convergence after {max_passes} passes: residuals {gap / value[0]}")


def category_history_svd(flat: DataFrame, key: str, cat_cols: list[str], k: int = 12, name: str = "cat") -> DataFrame:
    """category_history_svd: one-hot of the flattened history columns ->
    truncated SVD (uncentred, like TruncatedSVD), output X V.

    The one-hot rows stay lists of places; the vectors come from passes over them (:func:`leading_vectors`),
    and the projection adds up the loadings of a row's places.  Signs: largest |loading| positive.
    On the driver: the loadings, width x (k + 4) for each block of the basis."""
    rows, width = category_indices(flat, key, cat_cols)
    if not width:
        return rows.select(key, *[F.lit(0.0).alias(f"{name}_history_svd_{j}") for j in range(k)])
    _, v = leading_vectors(rows, width, k)
    v = v * np.where(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0, -1.0, 1.0)
    out, made = rows, []
    most = max(1, LOADING_BYTES // (8 * width))
    for lo in range(0, v.shape[1], most):
        shared = flat.sparkSession.sparkContext.broadcast(np.ascontiguousarray(v[:, lo:lo + most]))
        names = [f"{name}_history_svd_{j}" for j in range(lo, min(lo + most, v.shape[1]))]
        schema = T.StructType([*out.schema, *(T.StructField(c, T.DoubleType()) for c in names)])

        def run(batches, shared=shared, place=out.columns.index("__ix"), schema=schema):
            for b in batches:
                ix = b.column(place)
                size, flat_ix = pc.list_value_length(ix).to_numpy(), ix.flatten().to_numpy()
                row = np.repeat(np.arange(len(size)), size)
                made = [pa.array(np.bincount(row, shared.value[flat_ix, j], len(size))) for j in range(shared.value.shape[1])]
                yield pa.RecordBatch.from_arrays([*b.columns, *made], names=schema.names)

        out = out.mapInArrow(run, schema)
        made += names
    return out.select(key, *made)


# ---------------------------------------------------------------- scaling
def standard_scale(df: DataFrame, cols, fit_df: DataFrame | None = None) -> tuple[DataFrame, dict]:
    """standard_scale: (x - mean) / population std over ``fit_df`` (default df);
    std 0 -> 1.  Returns (scaled, stats)."""
    src = fit_df if fit_df is not None else df
    row = src.agg(*[F.avg(c).alias(f"mu_{c}") for c in cols], *[F.stddev_pop(c).alias(f"sd_{c}") for c in cols]).first()
    st = {c: (row[f"mu_{c}"], row[f"sd_{c}"] if row[f"sd_{c}"] else 1.0) for c in cols}
    return df.withColumns({c: (F.col(c) - F.lit(st[c][0])) / F.lit(st[c][1]) for c in cols}), st


def _skew_g1(c: Column) -> Column:
    n = F.count(c)
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def auto_log_transform(df: DataFrame, cols, threshold: float = 5.0) -> tuple[DataFrame, dict]:
    """auto_log_transform: replace x by log1p(x - min) (right skew) or
    log1p(max - x) (left skew) when |skew| drops by more than ``threshold``.
    Pass 1: min, max, skew; pass 2: skew of both log forms; then project."""
    r1 = df.agg(*[F.min(c).alias(f"mn_{c}") for c in cols], *[F.max(c).alias(f"mx_{c}") for c in cols],
                *[_skew_g1(F.col(c)).alias(f"sk_{c}") for c in cols]).first()
    logs = {}
    for c in cols:
        mn, mx = r1[f"mn_{c}"], r1[f"mx_{c}"]
        if mn is None:
            continue
        logs[c] = (F.log1p(F.col(c) - F.lit(mn)), F.log1p(F.lit(mx) - F.col(c)))
    r2 = df.agg(*[_skew_g1(logs[c][0]).alias(f"r_{c}") for c in logs], *[_skew_g1(logs[c][1]).alias(f"l_{c}") for c in logs]).first()
    decision = {}
    for c in logs:
        sk = r1[f"sk_{c}"]
        if sk is None or (isinstance(sk, float) and math.isnan(sk)):
            continue
        if sk > 0 and r2[f"r_{c}"] is not None and abs(sk) - abs(r2[f"r_{c}"]) > threshold:
            decision[c] = "log"
        elif sk <= 0 and r2[f"l_{c}"] is not None and abs(sk) - abs(r2[f"l_{c}"]) > threshold:
            decision[c] = "log_reverse"
    out = df.withColumns({c: logs[c][0] if k == "log" else logs[c][1] for c, k in decision.items()})
    return out, decision
