"""One named query per operator, over whole tables, and the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.llm import quality_rules, secrets
from starledger.llm.common import table
from starledger.llm.embedding_dedup import embedding_duplicates
from starledger.llm.exact_search import top_k
from starledger.llm.mixing import FLATTEN, PART_MEAN, TERMS, replicate, shuffled
from starledger.llm.near_dedup import near_duplicates
from starledger.llm.packing import pack_documents
from starledger.llm.quality_model import quality_scores
from starledger.llm.substring_dedup import remove_repeats
from starledger.llm.tokens import count_tokens
from starledger.llm.toxicity import toxicity_scores
from starledger.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, code_rows, compress
from starledger.llm.whitening import whiten

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffled(replicate(table(spark, sf_dir, "documents"), ["doc_id"]))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), ["doc_id"])
    of_kind = [
        F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
        for kind in secrets.KINDS[:3]
    ]
    return found.select(
        "doc_id", *of_kind, F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"), secrets.spans_text(F.col("spans")).alias("spans")
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_rows(spark, *compress(table(spark, sf_dir, "embeddings")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_minhash_dedup,
        op3_substring_dedup,
        op4_packing,
        op5_source_mixing,
        op6_token_counts,
        op7_embedding_dedup,
        op8_toxicity,
        op9_secret_scan,
        op10_quality_rules,
        op11_exact_search,
        op12_vector_codes,
        op13_whitening,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"
_STOPS = ", ".join(f"'{w}'" for w in sorted(set(quality_rules.STOP_WORDS)))
_BASE = " OR ".join(r.failed_sql() for r in quality_rules.BASE_RULES)
_FAIL = " OR ".join(r.failed_sql() for r in quality_rules.RULES)

_OP10 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS ws, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS ls FROM d),
win AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)),
rep AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid),
m AS (
  SELECT w.rid, doc_id, 1 AS one, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[{quality_rules.SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
    len(ls)::BIGINT AS n_lines,
    len(list_filter(ws, lambda x: x IN ({_STOPS})))::BIGINT AS n_stop_words,
    (length(t) - length(replace(t, '!', '')))::BIGINT AS n_shouts
  FROM w LEFT JOIN cov ON w.rid = cov.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  ({_BASE}) AS base_failed, NOT ({_BASE}) AND NOT ({_FAIL}) AS kept
FROM m
"""

# Every window that starts in several documents, with its first; then the words it covers.
_OP3 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
win AS (SELECT rid, doc_id, i, array_to_string(ws[i : i + 49], ' ') AS g FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)),
hit AS (SELECT rid, i FROM win QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 50)) AS p FROM hit),
word AS (SELECT rid, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT rid, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS s FROM word ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

_OP2 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 3], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
link AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT documents.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(reach.b) AS component_id, documents.doc_id = min(reach.b) AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = documents.doc_id GROUP BY documents.doc_id, n.n
"""

_OP7 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_dot_product(x.e, y.e) / sqrt(list_dot_product(x.e, x.e) * list_dot_product(y.e, y.e)) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(max(n.n), 0)::BIGINT AS n_links, min(reach.b)::BIGINT AS component_id, vec_id = min(reach.b) AS kept
FROM embeddings JOIN reach ON reach.a = vec_id LEFT JOIN n ON n.a = vec_id GROUP BY vec_id
"""

# A mean above PART_MEAN is drawn in several parts, as in the operator.
_OP5 = f"""
WITH RECURSIVE s AS (
  SELECT source, count(*) AS n, pow(count(*)::DOUBLE, {FLATTEN}) AS target FROM documents GROUP BY source),
r AS (SELECT source, target * (SELECT sum(n) FROM s) / (SELECT sum(target) FROM s) / n AS rate FROM s),
p AS (SELECT source, greatest(ceil(rate / {PART_MEAN}), 1)::INT AS parts, rate / greatest(ceil(rate / {PART_MEAN}), 1)::INT AS mean FROM r),
c AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS cdf FROM p
  UNION ALL SELECT source, mean, k + 1, p * mean / (k + 1), cdf + p * mean / (k + 1) FROM c WHERE k + 1 < {TERMS}),
steps AS (SELECT source, list(cdf ORDER BY k) FILTER (WHERE cdf < 1) AS cdf FROM c GROUP BY source),
key AS (SELECT *, '17|' || coalesce(doc_id::VARCHAR, '') AS key FROM documents),
drawn AS (
  SELECT key.*, list_sum(list_transform(range(1, parts + 1), lambda i:
    len(list_filter(cdf, lambda x: x <= ('0x' || substr(md5(key.key || '|' || i), 1, 12))::BIGINT / pow(16, 12)))))::BIGINT AS times
  FROM key JOIN p ON key.source IS NOT DISTINCT FROM p.source JOIN steps ON key.source IS NOT DISTINCT FROM steps.source),
copies AS (SELECT *, unnest(range(times))::INT AS copy FROM drawn)
SELECT doc_id, text, lang, source, n_chars, copy, ('0x' || substr(md5(key || '|place|' || copy), 1, 12))::BIGINT / pow(16, 12) AS place FROM copies
"""

_FINITE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

_OP11 = f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings WHERE {_FINITE}),
s AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.rid <> c.rid AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


def _op12_sql() -> str:
    """The rounds written out one by one; lists of one position each."""
    per = f"(len(e) // {PARTS})"
    steps = [
        f"v AS (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings WHERE {_FINITE})",
        f"p AS MATERIALIZED (SELECT rid, part, e[part * {per} + 1 : (part + 1) * {per}] AS x FROM v, range({PARTS}) AS r(part))",
        f"first AS (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT {ENTRIES})",
        "e0 AS MATERIALIZED (SELECT part, entry, x AS c FROM p JOIN first USING (rid))",
    ]
    for r in range(ROUNDS + 1):
        steps.append(
            f"a{r} AS MATERIALIZED (SELECT rid, p.part, any_value(x) AS x, min(struct_pack(d := list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, entry := entry)) AS m "
            f"FROM p JOIN e{r} USING (part) GROUP BY rid, p.part)"
        )
        if r < ROUNDS:
            steps.append(
                f"n{r} AS (SELECT part, entry, list(mean ORDER BY i) AS c FROM (SELECT part, m.entry AS entry, i, floor(sum(x[i]) / count(*))::BIGINT AS mean "
                f"FROM a{r}, range(1, len(x) + 1) AS r(i) GROUP BY part, m.entry, i) GROUP BY part, entry)"
            )
            steps.append(f"e{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(n{r}.c, e{r}.c) AS c FROM e{r} LEFT JOIN n{r} USING (part, entry))")
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, string_agg(printf('%02x', m.entry), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error,
  (sum(sum(m.d)) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM e{ROUNDS}) AS codebooks_sha256
FROM a{ROUNDS} JOIN v USING (rid) GROUP BY rid, vec_id, label
"""
    )


ORACLES = {
    "op2_minhash_dedup": _OP2,
    "op3_substring_dedup": _OP3,
    "op5_source_mixing": _OP5,
    "op7_embedding_dedup": _OP7,
    "op10_quality_rules": _OP10,
    "op11_exact_search": _OP11,
    "op12_vector_codes": _op12_sql(),
}
