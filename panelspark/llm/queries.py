"""Registered queries of the operators and their DuckDB SQL (where SQL can express one)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op12_recompression as op12
from . import op1_revisit, op2_chat, op3_bpe, op4_html, op5_license, op6_suffix_dedup, op7_minhash, op8_decontam, op9_forest, op10_toxicity, op11_merkle, op13_ranked

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query
def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op1_revisit.resolve(op1_revisit.records_of_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    out = out.select("revisit_id", "canonical", "ts", "response_id", "verdict", F.array_join(lines, "\n").alias("headers"), F.sha2("payload", 256).alias("payload_sha256"))
    # a page is one revisit, as in the SQL: of rows that repeat its id the largest
    rest = out.columns[1:]
    return out.groupBy("revisit_id").agg(F.max(F.struct(*rest)).alias("r")).select("revisit_id", *(F.col("r")[c].alias(c) for c in rest))


ORACLE["op1_warc_revisits"] = r"""
WITH p AS (SELECT page_id AS i, url, html, '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag FROM pages),
s AS (SELECT *, regexp_replace(trim(url), '#.*$', '') AS u, CASE WHEN i % 7 = 0 THEN 10 * i - 5 ELSE 10 * i + 1005 END AS later FROM p),
b AS (SELECT *, regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM s),
c AS (SELECT *, regexp_extract(rest, '^([^?]*)', 1) AS front, regexp_extract(rest, '\?(.*)$', 1) AS q FROM b),
d AS (SELECT *, regexp_replace(lower(regexp_replace(regexp_extract(front, '^([^/]*)', 1), '^.*@', '')), '^www[0-9]*\.', '') AS host,
  regexp_replace(regexp_extract(front, '^[^/]*(.*)$', 1), '/+$', '') AS path,
  list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|fbclid|gclid|ref|sessionid|phpsessid|jsessionid|sid)(=|$)'))) AS params FROM c),
e AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, CASE WHEN lower(u) LIKE 'https://%' THEN ':443$' ELSE ':80$' END, '')
  || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical FROM d),
j AS (SELECT v.i, v.canonical, v.later, v.tag AS vtag, f.i AS fi, f.html AS fhtml, f.tag AS ftag
  FROM e v LEFT JOIN e f ON v.canonical = f.canonical AND 10 * f.i < v.later
  QUALIFY row_number() OVER (PARTITION BY v.i ORDER BY f.i DESC NULLS LAST) = 1),
k AS (SELECT *, CASE WHEN fi IS NULL THEN 'no_response' WHEN i % 5 = 4 THEN 'no_validator'
  WHEN i % 5 < 2 AND vtag = ftag OR i % 5 = 2 AND i % 400 = fi % 400 THEN 'resolved' ELSE 'mismatch' END AS verdict FROM j)
SELECT 2 * i + 1 AS revisit_id, canonical, later AS ts, 2 * fi AS response_id, verdict,
  CASE WHEN verdict = 'resolved' THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || coalesce(strlen(fhtml), 0) || chr(10) || 'content-type: text/html' || chr(10)
    || 'date: ' || (i + 100) || chr(10) || 'etag: ' || CASE i % 5 WHEN 0 THEN vtag WHEN 1 THEN 'W/' || vtag ELSE ftag END || chr(10) || 'expires: later' || chr(10)
    || 'last-modified: day ' || CASE WHEN i % 5 = 2 THEN i % 400 ELSE fi % 400 END END AS headers,
  CASE WHEN verdict = 'resolved' THEN sha256(fhtml) END AS payload_sha256
FROM k"""


@query
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionAll(probe)
    formatted = op2_chat.format_turns(op2_chat.canonical_turns(op2_chat.pack(rows)))
    return op2_chat.read_back(formatted.select("conv_id", "formatted", "loss_runs")).select("conv_id", *op2_chat.digests())


ORACLE["op2_chat_format"] = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (
  SELECT *, length(replace(replace(role, '%', '%25'), chr(10), '%0A'))
      + len(regexp_extract_all(role || chr(10) || text, '[<\[]\\*(\||/?s>|/?INST\]|</?SYS>)')) + length(text) + 13 + 11 AS chars FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id"""


@query
def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op3_bpe.encode(docs, tokenizer_path(), decoded=True).select("doc_id", *op3_bpe.digests())


@query
def op4_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "visible_text")


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_license.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_license_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_license.spans(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _notices() -> str:
    return ", ".join("({}, '{}', '{}')".format(i, a, b.replace("'", "''")) for i, (a, b) in enumerate(op5_license.NOTICES))


ORACLE["op5_license_scan"] = f"""
WITH t0 AS (SELECT template, license, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM (VALUES {_notices()}) v(template, license, text)),
t AS (SELECT template, license, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS tb FROM t0 WHERE len(w) > 1),
l AS (
  SELECT doc_id, unnest(list_zip(range(1, len(string_split(text, chr(10))) + 1), string_split(text, chr(10)))) AS x FROM documents WHERE text IS NOT NULL),
u AS (
  SELECT doc_id, x[1] AS line, x[2] AS unit FROM l
  UNION ALL SELECT doc_id, 0, text FROM documents WHERE contains(text, chr(10))),
w AS (SELECT doc_id, line, regexp_extract_all(lower(unit), '[a-z0-9]+') AS w FROM u),
b AS (SELECT doc_id, line, len(w) AS n_words, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS ub FROM w WHERE len(w) > 1),
d AS (
  SELECT doc_id, line, license, template, n_words, 2.0::DOUBLE * len(list_intersect(ub, tb)) / (len(ub) + len(tb)) AS dice
  FROM b JOIN t ON len(ub) BETWEEN len(tb) * 0.6 AND len(tb) * 1.6)
SELECT doc_id, line::BIGINT AS line, license, template, dice, n_words::BIGINT AS n_words FROM d
WHERE dice >= 0.8 QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, template) = 1"""


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op6_suffix_dedup.dedup(docs).select("doc_id", *op6_suffix_dedup.digests())


@query
def op7_chosen_path_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op7_minhash.classify(docs).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op8_decontam.flag(docs, table(spark, sf_dir, "benchmark")).select("doc_id", *op8_decontam.digests())


@query
def op9_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return op9_forest.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@query
def op10_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = op10_toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return op10_toxicity.score(docs, model).select("doc_id", op10_toxicity.held_out().alias("held_out"), "score", "predicted")


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*op11_merkle.FIELDS)
    return op11_merkle.manifest(docs, more={"changed": op11_merkle.tampering()}).select("doc_id", *op11_merkle.digests())


def _merkle_sql(levels: int = 8) -> str:
    """A tree level per pair of tables, up to 16**levels leaves a source and as many sources."""
    def climb(name: str, first: str, key: str) -> list[str]:
        out, at = [], first
        for k in range(1, levels + 1):
            out.append(f"""{name}{k} AS (SELECT {key}, i // 16 AS i, any_value(n) AS n,
  CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d, any_value(n) = 1 AS done FROM {at} GROUP BY {key}, i // 16)""")
            out.append(f"{name}n{k} AS (SELECT {key}, i, count(*) OVER (PARTITION BY {key}) AS n, d, done FROM {name}{k})")
            at = f"{name}n{k}"
        return out

    def siblings(name: str, first: str, key: str) -> list[str]:
        """Of each node and level, the others of its run; before and after it."""
        out = []
        for k in range(levels):
            at = first if k == 0 else f"{name}n{k}"
            out.append(f"""{name}s{k} AS (SELECT {key}, i, n > 1 AS up,
  coalesce(string_agg(d, '') OVER (PARTITION BY {key}, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
  coalesce(string_agg(d, '') OVER (PARTITION BY {key}, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM {at})""")
        return out

    part = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(part(text if f == "text" else f) for f in op11_merkle.FIELDS) + ")"
    lowered = f"translate(text, '{op11_merkle.UPPER}', '{op11_merkle.LOWER}')"
    ctes = [
        """o AS (SELECT *, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: list_concat([ascii(ch)::BIGINT], [-1::BIGINT FOR z IN range(8)])))),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END) AS crc FROM documents)""",
        f"l AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN {leaf(lowered)} END AS changed FROM o)",
        "t AS (SELECT source, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree, doc_id, leaf, changed FROM l)",
        "x0 AS (SELECT *, tree AS k, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n, leaf AS d FROM t)",
        *climb("x", "x0", "k"), *siblings("x", "x0", "k"),
        f"y0 AS (SELECT 0 AS k, k AS i, count(*) OVER () AS n, d FROM xn{levels})",
        *climb("y", "y0", "k"), *siblings("y", "y0", "k"),
    ]
    ctes.append("f0 AS (SELECT doc_id, leaf, k, i, coalesce(changed, leaf) AS d, '' AS p FROM x0)")
    for n in range(2 * levels):
        name, k = ("x", n) if n < levels else ("y", n - levels)
        at = f"s.k = f.k AND s.i = f.i // {16 ** k}" if name == "x" else f"s.i = f.k // {16 ** k}"
        ctes.append(f"""f{n + 1} AS (SELECT f.* EXCLUDE (d, p), CASE WHEN s.up THEN sha256(s.a || f.d || s.b) ELSE f.d END AS d,
  p || CASE WHEN s.up THEN s.a || s.b ELSE '' END AS p FROM f{n} f JOIN {name}s{k} s ON {at})""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT f.doc_id, f.leaf, x.d AS subroot, y.d AS root, sha256(f.p) AS proof_sha256, f.d AS folded_root, f.d = y.d AS verified
FROM f{2 * levels} f JOIN xn{levels} x ON x.k = f.k CROSS JOIN yn{levels} y"""


ORACLE["op11_merkle_manifest"] = _merkle_sql()


@query
def op12_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op12.dedup(docs, made=op12.digests()).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE["op12_recompression"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
p AS (SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM s),
m AS (SELECT g, min(doc_id) AS f FROM p GROUP BY g),
h AS (SELECT r, i FROM p JOIN m USING (g) WHERE f < doc_id),
x AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
c AS (
  SELECT x.r, x.i, x.word, max(CASE WHEN h.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY x.r ORDER BY x.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM x LEFT JOIN h ON x.r = h.r AND x.i = h.i),
k AS (SELECT r, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM c GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)"""


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op13_ranked.search(docs, table(spark, sf_dir, "benchmark"))


ORACLE["op13_ranked_search"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, '{op11_merkle.UPPER}', '{op11_merkle.LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
x AS (SELECT r, doc_id, w, len(w) AS n FROM d WHERE len(w) > 0),
s AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS l FROM x),
u AS (SELECT r, doc_id, n, unnest(w) AS t FROM x),
tf AS (SELECT r, t, any_value(doc_id) AS doc_id, any_value(n)::BIGINT AS n, count(*)::BIGINT AS tf FROM u GROUP BY r, t),
df AS (SELECT t, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY t),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{op11_merkle.UPPER}', '{op11_merkle.LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
c AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // l))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN df USING (t), s GROUP BY item_id, r)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM c WHERE score > 0 QUALIFY rank <= 50"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
