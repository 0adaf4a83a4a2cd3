"""One query per operator of this subpackage, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from binscope.llm import (decontaminate, html, language, lm, neardup, periodic, pieces, quality, secrets, spelling, suffixes, token_counts,
                          toxicity)
from binscope.llm.text import crc_bucket
from binscope.session import ensure_checkpoint_dir, table_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; it must be the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, _table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    hit = F.aggregate("_leak.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", F.col("_leak.n_words").alias("n_words"), hit.alias("n_hit"),
        F.size("_leak.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_leak.items").cast("binary"), 256).alias("items_sha256"),
        (F.size("_leak.spans") > 0).alias("contaminated"))


ORACLE["op1_decontaminate"] = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, list_slice(ws, i, i + least(len(ws), 10) - 1) AS win
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT r, n, i, list_slice(ws, i, i + n - 1) AS win
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, sizes WHERE len(ws) >= n)),
hits AS (SELECT r, i, dw.n, item_id FROM dw JOIN win ON dw.n = win.n AND dw.win = win.win),
hw AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
hi AS (SELECT r, count(DISTINCT item_id) AS n_items,
         array_to_string(list_sort(list(DISTINCT item_id)), ',') AS items FROM hits GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)"""


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, _table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, keep=["doc_id"]).select("doc_id", "_quality.*")


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_documents(docs, tokenizer_path("piece_bpe_32k.model"), keep=["doc_id"]).select("doc_id", "_pieces.*")


@query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("_secrets.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.listed(F.col("_secrets.base")).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("_secrets.spans")).alias("spans"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.fit_languages(docs.filter(crc_bucket(3) != 1).select("doc_id", "text", "lang"))
    found = language.predict_language(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", (crc_bucket(3) == 1).alias("held_out"), "_language.*")


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    learned_from = _table(spark, sf_dir, "labels").filter(crc_bucket(5) != 0).select("doc_id", "toxic")
    found = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, learned_from), keep=["doc_id"])
    score = F.col("_toxicity.score")
    return found.select("doc_id", (crc_bucket(5) == 0).alias("held_out"), score.alias("score"),
                        (score >= 0.5).cast("int").alias("predicted"), F.col("_toxicity.n_matches").alias("n_matches"))


@query
def op10_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract_pages(pages, keep=["page_id", "url"]).select("page_id", "url", "_main.*")


@query
def op4_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicate_classes(docs).select("doc_id", "class_id")


# The classes by their definition: all links between distinct texts that share a shingle, and their closure.
ORACLE["op4_probminhash"] = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
t AS (SELECT ws, min(r) AS t FROM w WHERE len(ws) > 0 GROUP BY ws),
s AS (SELECT DISTINCT t, list_slice(ws, i, i + least(len(ws), 5) - 1) AS x
      FROM (SELECT t, ws, unnest(range(1, len(ws) - least(len(ws), 5) + 2)) AS i FROM t)),
n AS (SELECT t, count(*) AS n FROM s GROUP BY t),
c AS (SELECT a.t AS a, b.t AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.t <> b.t GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n na ON a = na.t JOIN n nb ON b = nb.t WHERE k >= 0.8 * (na.n + nb.n - k)),
reach AS (SELECT t AS a, t AS b FROM t UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
comp AS (SELECT a AS t, min(b) AS comp FROM reach GROUP BY a),
doc AS (SELECT w.doc_id, w.r, comp.comp FROM w LEFT JOIN t ON w.ws = t.ws LEFT JOIN comp ON t.t = comp.t),
least_id AS (SELECT comp, min(doc_id) AS class_id FROM doc WHERE comp IS NOT NULL GROUP BY comp)
SELECT doc_id, CASE WHEN doc.comp IS NULL THEN doc_id ELSE class_id END AS class_id
FROM doc LEFT JOIN least_id ON doc.comp = least_id.comp"""


@query
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


# All strings of 200 bytes by their own digest, and the bytes that repeated ones cover.
ORACLE["op7_suffix_array_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, s, md5(substr(h, CAST(2 * s + 1 AS INT), 400)) AS m
      FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 199)) AS s FROM d WHERE length(h) >= 400)),
rep AS (SELECT m FROM w GROUP BY m HAVING count(*) > 1),
hit AS (SELECT r, s, lag(s) OVER (PARTITION BY r ORDER BY s) AS p FROM w JOIN rep USING (m)),
grp AS (SELECT r, s, sum(CASE WHEN p IS NULL OR s > p + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY s) AS g FROM hit),
span AS (SELECT r, g, min(s) AS a, max(s) + 200 AS b FROM grp GROUP BY r, g),
gap AS (SELECT r, g, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS z FROM span),
kept AS (SELECT r, string_agg(substr(h, CAST(2 * z + 1 AS INT), CAST(2 * (a - z) AS INT)), '' ORDER BY a) AS k,
           max(b) AS last, sum(b - a) AS n_removed, count(*) AS n_spans FROM gap JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(k || substr(h, CAST(2 * last + 1 AS INT)), h))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


@query
def op3_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(_table(spark, sf_dir, "documents").select("doc_id", "text"), crc_bucket(7) == 2)


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.spelling_variants(docs, change=spelling.drop_one)


# crc32 in SQL: a step of the register for one byte, and the table that its rule gives.
_CRC_TABLE = """crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))"""


def _crc32(text: str) -> str:
    octets = f"list_transform(range(strlen({text})), lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS INT), 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295)"


# Near words by the strings that they become without one code point.
ORACLE["op11_spelling_variants"] = rf"""
WITH RECURSIVE {_CRC_TABLE},
run AS (
  SELECT id, run, count(*) AS k FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, k, {_crc32("(id || ':' || run)")} AS h FROM run, crc),
changed AS (
  SELECT k, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) + 2 AS INT))
    ELSE run END AS word FROM hashed),
word AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
less AS (SELECT word, n, i, substr(word, 1, CAST(i - 1 AS INT)) || substr(word, CAST(i + 1 AS INT)) AS s
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)),
pair AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.s = b.s AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN word b ON a.s = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN word b ON a.s = b.word),
about AS (SELECT word, count(*) AS n_near, max(near_n) AS top FROM pair GROUP BY word),
best AS (SELECT p.word, min(near) AS form, min(top) AS form_n FROM pair p JOIN about a ON p.word = a.word AND near_n = top
         WHERE near_n >= 5 * n GROUP BY p.word),
chain AS (SELECT word, word AS root, 0 AS d FROM word
          UNION ALL SELECT chain.word, best.form, d + 1 FROM chain JOIN best ON chain.root = best.word),
root AS (SELECT word, arg_max(root, d) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, form_n
FROM word JOIN root USING (word) LEFT JOIN about USING (word) LEFT JOIN best USING (word)"""


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.find_runs(docs, keep=["doc_id"], loop=periodic.planted_loop)
    runs = F.col("_periodic.runs")
    ranked = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    longest = F.when(F.size(runs) > 0, F.array_max(ranked))
    listed = F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))

    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    return found.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), (-longest["s"]).alias("start"), longest["length"].alias("length"),
        (-longest["p"]).alias("period"), F.floor(1000 * longest["length"] / -longest["p"]).alias("exponent_milli"),
        digest(F.array_join(listed, "")).alias("runs_sha256"), digest(F.col("_periodic.collapsed")).alias("collapsed_sha256"))


# Runs by definition: places whose word is the same q words further on, consecutive ones merged, the least q of each stretch.
ORACLE["op12_periodic_runs"] = rf"""
WITH {_CRC_TABLE},
split AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS ws,
    {_crc32("coalesce(CAST(doc_id AS VARCHAR), '')")} AS h FROM documents, crc),
loop AS (
  SELECT r, doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS looped,
    CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a, 3 + (h // 10) % 8 AS parts FROM split),
doc AS (
  SELECT r, doc_id, CASE WHEN looped THEN list_transform(range(n),
    lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END + 1]) ELSE ws END AS ws FROM loop),
place AS (SELECT r, unnest(range(len(ws))) AS i, unnest(ws) AS w FROM doc),
same AS (SELECT x.r, x.i, y.i - x.i AS q FROM place x JOIN place y ON x.r = y.r AND x.w = y.w AND x.i < y.i),
island AS (SELECT r, q, min(i) AS start, max(i) + 1 - min(i) + q AS length
           FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM same) GROUP BY r, q, g),
run AS (SELECT r, start, length, min(q) AS q FROM island WHERE length >= greatest(12, 2 * q) GROUP BY r, start, length),
listed AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS l,
             arg_max(struct_pack(start, length, q), struct_pack(length, b := -start, c := -q)) AS top FROM run GROUP BY r),
dropped AS (SELECT DISTINCT r, i FROM (SELECT r, unnest(range(start + q, start + length)) AS i FROM run)),
kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS t FROM place ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, top.start AS start, top.length AS length, top.q AS period,
  CAST(1000 * top.length // top.q AS BIGINT) AS exponent_milli, sha256(coalesce(l, '')) AS runs_sha256,
  sha256(coalesce(t, '')) AS collapsed_sha256
FROM doc LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)"""


#: Tokens that a document may have.
TOKEN_LIMIT = 2048


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = token_counts.count_tokens(docs, tokenizer_path("word_bpe_49k.json"), keep=["doc_id"])
    return found.select("doc_id", "_tokens.*", (F.col("_tokens.n_tokens") > TOKEN_LIMIT).alias("over_limit"))
