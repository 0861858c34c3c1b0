"""Queries of the training-data operators and the SQL that DuckDB can run for them.

Each ``opN_`` query applies its operator to a whole table with production
parameters and derives the columns that its contract names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import lookup_join
from ..sources.tables import read_table
from . import (ball_kmeans, compact_windows, filter_audit, fuzzy_lines, gru_language, impact_topk, lbl_lm, packing_swap, secret_markov,
               simhash_ball, token_counts, weak_toxicity, wu_manber)
from .common import remainder

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside ten-word windows of benchmark items."""
    found = wu_manber.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS_SQL = f"regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), " \
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1_SQL = f"""
WITH iw AS (SELECT item_id, {_WORDS_SQL} AS ws FROM benchmark WHERE item_id IS NOT NULL),
iws AS (SELECT item_id, ws, len(ws) AS n, least(len(ws), 10) AS k FROM iw WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(ws[s:s + k - 1], ' ') AS w
        FROM iws, generate_series(1, n - k + 1) AS g(s)),
d AS (SELECT doc_id, row_number() OVER () AS rid, {_WORDS_SQL} AS ws FROM documents),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT rid, s, ks.k AS k, array_to_string(ws[s:s + ks.k - 1], ' ') AS w
       FROM d, ks, generate_series(1, len(ws) - ks.k + 1) AS g(s)),
occ AS (SELECT rid, s, dw.k AS k, item_id FROM dw JOIN win ON dw.k = win.k AND dw.w = win.w),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM occ, generate_series(s, s + k - 1) AS g(p) GROUP BY rid),
it AS (SELECT rid, count(DISTINCT item_id) AS n_items,
              array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids FROM occ GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)
"""


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products of every fiftieth vector against all others."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return impact_topk.top_k(vectors, vectors.filter(F.pmod("vec_id", F.lit(50)) == 0), k=5)


OP2_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
             CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT query_id, vec_id, score,
             CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned where crc32(doc_id) mod 4 is not 2."""
    docs = read_table(spark, sf_dir, "documents")
    held = remainder("doc_id", 4) == 2
    model = gru_language.fit(docs, learn=~held)
    return gru_language.identified(docs.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that each document shares with another one."""
    found = compact_windows.repeated_passages(read_table(spark, sf_dir, "documents"))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["first"].cast("string"), (s["last"] + 1).cast("string")))
    return found.select("doc_id", "n_passages", "n_words_repeated", F.array_join(spans, ",").alias("spans"),
                        F.col("component").alias("component_id"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by pattern and by Markov models."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_markov.scan(docs, secret_markov.fit(docs))
    base = F.filter("__spans", lambda s: s["kind"] != secret_markov.ADDED)
    joined = lambda spans: F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("__spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in secret_markov.KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("__spans")).alias("spans"),
        count(secret_markov.ADDED).alias("n_markov"))


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document, learned where crc32(doc_id) mod 10 is not 0."""
    return lbl_lm.scores(read_table(spark, sf_dir, "documents"), remainder("doc_id", 10) == 0)


def op7_packing(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """All documents as pieces of sequences of at most 4096 tokens."""
    return packing_swap.packed(read_table(spark, sf_dir, "documents"), tokenizer_path or public_tokenizer())


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of an installed public vocabulary file."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document and the numbers (from 0) of those that repeat an earlier line."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")
    gone = F.coalesce(F.size("__removed"), F.lit(0)).cast("long")
    return fuzzy_lines.with_removed(docs, rule=fuzzy_lines.WIDE).select(
        "doc_id", F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(counted).alias("n_lines"),
        F.when(F.col("__removed").isNull(), F.lit(0).cast("long")).otherwise(gone).alias("n_removed"),
        F.coalesce(F.array_join(F.transform("__removed", lambda i: i.cast("string")), ","), F.lit("")).alias("removed"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate class of each document: three-word shingles, three bits."""
    out = simhash_ball.near_duplicate_classes(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned where crc32(doc_id) mod 4 is not 2."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held = remainder("doc_id", 4) == 2
    model = weak_toxicity.fit(docs, read_table(spark, sf_dir, "labels"), learn=~held)
    return weak_toxicity.scored(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= weak_toxicity.THRESHOLD).cast("int").alias("predicted"))


TOKEN_LIMIT = 2048


def op11_tokens(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.with_counts(docs, tokenizer_path or public_tokenizer()).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight-part codes of every vector, their errors, and the errors of each label."""
    coded, books = ball_kmeans.compressed(read_table(spark, sf_dir, "embeddings"))
    coded = coded.withColumn("__label", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)"))
    totals = coded.groupBy("__label").agg(total.cast("long").alias("label_error"))
    digits = [F.lower(F.hex(F.substring("codes", p + 1, 1))) for p in range(ball_kmeans.PARTS)]
    return lookup_join(coded, totals, "__label", "inner").select(
        "vec_id", F.concat(*digits).alias("code"), "error", "label_error",
        F.lit(ball_kmeans.digest(books)).alias("codebooks_sha256"))


def _op12_sql() -> str:
    """Assignment and update, unrolled over the rounds; integers throughout."""
    floors = "list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT))"
    lines = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, {floors} AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
w AS MATERIALIZED (SELECT rid, p, x[p * (len(x) // 8) + 1:(p + 1) * (len(x) // 8)] AS c FROM v, generate_series(0, 7) AS g(p)),
b0 AS MATERIALIZED (SELECT p, e, c FROM w JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v
  WHERE vec_id IS NOT NULL ORDER BY vec_id LIMIT 16) USING (rid))"""]
    for r in range(ball_kmeans.ROUNDS + 1):
        lines.append(f"""d{r} AS MATERIALIZED (SELECT rid, w.p AS p, min(ROW(CAST(list_sum(list_transform(list_zip(w.c, b.c),
  lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), e)) AS m FROM w JOIN b{r} b ON w.p = b.p GROUP BY rid, w.p)""")
        if r < ball_kmeans.ROUNDS:
            lines.append(f"""s{r} AS (SELECT p, e, list(q ORDER BY i) AS c FROM (SELECT d.p AS p, d.m[2] AS e, i,
  CAST(sum(w.c[i]) // count(*) - CASE WHEN sum(w.c[i]) % count(*) < 0 THEN 1 ELSE 0 END AS BIGINT) AS q
  FROM d{r} d JOIN w ON d.rid = w.rid AND d.p = w.p, generate_series(1, len(w.c)) AS g(i) GROUP BY d.p, d.m[2], i) GROUP BY p, e),
b{r + 1} AS MATERIALIZED (SELECT b.p AS p, b.e AS e, coalesce(s.c, b.c) AS c FROM b{r} b LEFT JOIN s{r} s ON b.p = s.p AND b.e = s.e)""")
    last = ball_kmeans.ROUNDS
    lines.append(f"""f AS (SELECT rid, string_agg(lower(printf('%02x', CAST(m[2] AS INTEGER))), '' ORDER BY p) AS code,
  CAST(sum(m[1]) AS BIGINT) AS error FROM d{last} GROUP BY rid),
h AS (SELECT sha256(string_agg(t, ',' ORDER BY p, e)) AS codebooks_sha256 FROM
  (SELECT p, e, array_to_string(c, ',') AS t FROM b{last}))""")
    return "WITH " + ",\n".join(lines) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN f USING (rid), h"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from each language's documents, in every order."""
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x FROM documents),
m AS (SELECT doc_id, part, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY x) AS low FROM t),
l AS (SELECT doc_id AS id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS q, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS tox
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
        100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x), regexp_matches(x, '[#$%&*|]'),
        coalesce(low < doc_id, FALSE)] AS b, coalesce(q, 0) AS q, coalesce(tox, 0) AS tox
      FROM m LEFT JOIN l ON m.doc_id = l.id),
g AS (SELECT part, b, count(*) AS n, sum(q) AS good, sum(tox) AS toxic FROM f GROUP BY part, b),
c AS (SELECT i, substr('ABCDE', i, 1) AS a FROM generate_series(1, 5) AS s(i)),
o AS (SELECT a.a || b.a || d.a || e.a || h.a AS filter_order, [a.i, b.i, d.i, e.i, h.i] AS p FROM c a, c b, c d, c e, c h
      WHERE len(list_distinct([a.i, b.i, d.i, e.i, h.i])) = 5),
s AS (SELECT filter_order, p, CAST(step AS INTEGER) AS step FROM o, generate_series(1, 5) AS k(step)),
r AS (SELECT part, filter_order, step, p[step] AS letter, n, good, toxic, b[p[step]] AS here,
        len(list_filter(p[1:step - 1], lambda i: b[i])) > 0 AS earlier, len(list_filter(b, lambda y: y)) AS fails FROM g, s),
a AS (SELECT part, filter_order, step, letter, sum(CASE WHEN NOT here AND NOT earlier THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN here AND NOT earlier THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN here AND earlier THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN here AND fails = 1 THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN here AND NOT earlier THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN here AND NOT earlier THEN toxic ELSE 0 END) AS toxic_lost FROM r GROUP BY ALL),
v AS (SELECT part, letter, sum(removed) AS shapley FROM a GROUP BY part, letter)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(shapley AS BIGINT) AS shapley
FROM a JOIN v USING (part, letter)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_topk": op2_topk,
    "op3_language": op3_language,
    "op4_passages": op4_passages,
    "op5_secrets": op5_secrets,
    "op6_lm": op6_lm,
    "op7_packing": op7_packing,
    "op8_lines": op8_lines,
    "op9_simhash": op9_simhash,
    "op10_toxicity": op10_toxicity,
    "op11_tokens": op11_tokens,
    "op12_codes": op12_codes,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": OP1_SQL,
    "op2_topk": OP2_SQL,
    "op12_codes": _op12_sql(),
    "op13_filter_audit": OP13_SQL,
}
