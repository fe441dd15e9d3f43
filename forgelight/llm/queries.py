"""The registered queries of this subpackage: thin uses of its operators over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontamination, langid, licenses, merkle, packing, periodic, pii, sharding, simhash, topk, toxicity, url_filter
from .common import held_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The vocabulary file that op8 and the pipeline use; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: The key of the surrogates here; a user's own is a secret of theirs.
PII_KEY = b"forgelight queries"

URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, k=20, scale=64.0)
    return found.select("query_id", "rank", "vec_id", "score")


def op2_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = toxicity.training_rows(docs, table(spark, sf_dir, "labels"), lambda i: ~held_out(i))
    scored = toxicity.score(docs, toxicity.train(rows))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, bits=3)


def op4_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.summary(decontamination.scan(docs, table(spark, sf_dir, "benchmark"), window=10))


def op5_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs, lambda i: ~held_out(i)))
    return found.withColumn("held_out", held_out(F.col("doc_id")))


def op6_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, PII_KEY).withColumn("n_entities", F.size("entities"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 40).withColumn("grown_shard", F.lit(None).cast("int"))


def op10_url_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def _planted(doc_id, text):
    """A tenth of texts, by their ids, with their tails made periodic, as the contract of op11 says."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")

    def tail(words):
        n = F.size(words)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
        copies = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(copies, F.lit(1), n - a)), " ")

    # the words are bound to a name, so that they are made once
    made = F.element_at(F.transform(F.array(words), tail), 1)
    return F.when((h % 10 == 0) & text.isNotNull(), made).otherwise(text)


def op11_maximal_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.find_runs(docs, min_length=12)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"),
    )


def op12_rank_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    found = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256")
    decoded = bpe.decode(found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest, "ids"), path)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_slot_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.translate("text", ascii_uppercase, ascii_lowercase)).otherwise(F.col("text"))
    rows = docs.select("doc_id", "source", merkle.leaf(*values).alias("leaf"), merkle.leaf(*values[:-1], tampered).alias("found"))
    made = merkle.manifest(rows)
    made = made.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), merkle.fold(F.col("found"), F.col("path")).alias("folded_root"))
    return made.withColumn("verified", F.col("folded_root") == F.col("root"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_threshold_topk, op2_boosted_toxicity, op3_simhash_variants, op4_suffix_automaton, op5_nearest_centroid, op6_license_digests, op7_surrogates, op8_best_fit_packing, op9_sampled_splitters, op10_url_digests, op11_maximal_pairs, op12_rank_array, op13_slot_pivot)}


URL_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
judged AS (
  SELECT page_id, host, path,
         (SELECT max_by(struct_pack(rule := rule_host || rule_path, verdict := rule_verdict),
                        length(rule_host || rule_path))
          FROM rules
          WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS hit
  FROM parts)
SELECT page_id, host, path, hit.rule AS rule, coalesce(hit.verdict, 'allow') AS verdict FROM judged
"""


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.z, c.z), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.z) = len(c.z)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


WORDS_SQL = r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
CONTAMINATED_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS_SQL} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS t
  FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS x(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, p, array_to_string(w[p : p + k - 1], ' ') AS t FROM (SELECT * FROM d, sizes) s, unnest(range(1, len(w) - k + 2)) AS x(p)),
hit AS (SELECT doc_id, dw.k, p, item FROM dw JOIN win ON dw.t = win.t AND dw.k = win.k),
pos AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items, sha256(coalesce(its.s, '')) AS items_sha256,
       coalesce(pos.n, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""


MERKLE_SQL = """
WITH RECURSIVE
step(b, k, v) AS (
  SELECT b, 0, b FROM range(256) AS x(b)
  UNION ALL SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM step WHERE k < 8),
tab AS (SELECT b, v FROM step WHERE k = 8),
crc(doc_id, s, i, r) AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL SELECT c.doc_id, c.s, c.i + 1, xor(t.v, c.r >> 8) FROM crc c JOIN tab t ON t.b = xor(c.r & 255, CAST(ascii(c.s[c.i + 1]) AS BIGINT)) WHERE c.i < length(c.s)),
bad AS (SELECT doc_id FROM crc WHERE i = length(s) AND xor(r, 4294967295) % 5 = 0),
src AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT source FROM documents)),
named AS (
  SELECT s.g, d.doc_id, b.doc_id IS NOT NULL AS touched, d.text,
         coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-') || coalesce(strlen(d.source) || ':' || d.source, '-')
           || coalesce(strlen(d.lang) || ':' || d.lang, '-') || coalesce(strlen(CAST(d.n_chars AS VARCHAR)) || ':' || d.n_chars, '-') AS head
  FROM documents d JOIN src s ON d.source IS NOT DISTINCT FROM s.source LEFT JOIN bad b ON d.doc_id = b.doc_id),
hashed AS (
  SELECT g, doc_id, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(text) || ':' || CASE WHEN touched THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS found
  FROM named),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM hashed),
lv(level, g, pos, n, d) AS (
  SELECT 0, g, pos, n, leaf FROM leaves
  UNION ALL SELECT level + 1, g, pos // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY pos)) FROM lv WHERE n > 1 GROUP BY level, g, pos // 16, n),
sub AS (SELECT g, d FROM lv WHERE n = 1),
tv(level, pos, n, d) AS (
  SELECT 0, g, count(*) OVER (), d FROM sub
  UNION ALL SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY pos)) FROM tv WHERE n > 1 GROUP BY level, pos // 16, n),
link AS (
  SELECT level, g, pos, coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b, coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM lv WHERE n > 1 WINDOW w AS (PARTITION BY level, g, pos // 16 ORDER BY pos)),
toplink AS (
  SELECT level, pos, coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b, coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM tv WHERE n > 1 WINDOW w AS (PARTITION BY level, pos // 16 ORDER BY pos)),
walk(g, leafpos, level, pos, cur, seen) AS (
  SELECT g, pos, 0, pos, found, '' FROM leaves
  UNION ALL SELECT w.g, w.leafpos, w.level + 1, w.pos // 16, sha256(l.b || w.cur || l.a), w.seen || l.b || l.a FROM walk w JOIN link l ON w.level = l.level AND w.g = l.g AND w.pos = l.pos),
ended AS (SELECT g, leafpos, arg_max(cur, level) AS cur, arg_max(seen, level) AS seen FROM walk GROUP BY g, leafpos),
climb(g, leafpos, level, pos, cur, seen) AS (
  SELECT g, leafpos, 0, g, cur, seen FROM ended
  UNION ALL SELECT w.g, w.leafpos, w.level + 1, w.pos // 16, sha256(l.b || w.cur || l.a), w.seen || l.b || l.a FROM climb w JOIN toplink l ON w.level = l.level AND w.pos = l.pos),
done AS (SELECT g, leafpos, arg_max(cur, level) AS cur, arg_max(seen, level) AS seen FROM climb GROUP BY g, leafpos)
SELECT v.doc_id, v.leaf, s.d AS subroot, r.d AS root, sha256(e.seen) AS proof_sha256, e.cur AS folded_root, e.cur = r.d AS verified
FROM leaves v JOIN sub s ON v.g = s.g JOIN done e ON v.g = e.g AND v.pos = e.leafpos CROSS JOIN (SELECT d FROM tv WHERE n = 1) r
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_threshold_topk": TOPK_SQL, "op4_suffix_automaton": CONTAMINATED_SQL, "op10_url_digests": URL_SQL, "op13_slot_pivot": MERKLE_SQL}
