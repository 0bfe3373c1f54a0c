"""Registered queries of the corpus operators, over the driver's whole tables.

Each thin query calls its operator with production parameters and derives the
contract's columns; ORACLES holds DuckDB SQL where SQL can say the operator.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavefold.llm import (byte_bpe, collocations, dac, decontaminate, html_extract, jaccard_join, line_dedup, periodic_runs, prefix_counts,
                          quality_rules, sharding, simhash, toxicity)
from wavefold.llm.common import shared_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKEN_LIMIT = 512
SHARDS = 16
BENCHMARK_WINDOW = 10


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = prefix_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                         limits=(TOKEN_LIMIT,))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
                          F.col(f"fits_{TOKEN_LIMIT}").alias("chars_within_limit"))


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_path(spark, "token-codes")
    dac.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), out, end_id=1)
    return dac.documents(dac.read(spark, out), digest_only=True)


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_kept").alias("n_kept"),
                       F.sha2("text", 256).alias("text_sha256"))


# near lines are looked for under equal halves, as two lines one edit apart have one half in common
ORACLES["op4_line_dedup"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, ls[i] AS line, lower(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS norm
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
f AS (SELECT norm, length(norm) AS n, min((doc_id, i)) AS place FROM l WHERE norm <> '' GROUP BY norm),
k AS (
  SELECT norm, place, m, 'a' AS side, left(norm, m // 2) AS half FROM (SELECT *, unnest([n, n - 1]) AS m FROM f WHERE n >= 16)
  UNION ALL
  SELECT norm, place, m, 'b', right(norm, m - m // 2) FROM (SELECT *, unnest([n, n - 1]) AS m FROM f WHERE n >= 16)),
near AS (SELECT DISTINCT x.norm FROM k x JOIN k y ON x.m = y.m AND x.side = y.side AND x.half = y.half
         WHERE y.place < x.place AND levenshtein(x.norm, y.norm) = 1),
t AS (SELECT l.doc_id, l.i, l.line,
             l.norm = '' OR (f.place = (l.doc_id, l.i) AND near.norm IS NULL) AS stays
      FROM l LEFT JOIN f ON l.norm = f.norm LEFT JOIN near ON l.norm = near.norm)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (stays) AS n_kept,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS text_sha256
FROM t GROUP BY doc_id
"""


@query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def toxicity_categories(labels: DataFrame) -> dict[str, Column]:
    """The chain's categories, from the labels at hand: toxic junk, toxic prose, and toxic, which decides, last."""
    toxic, good = labels["toxic"] == 1, labels["quality"] == 1
    return {"toxic_junk": toxic & ~good, "toxic_prose": toxic & good, "toxic": toxic}


def fitted_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Chain:
    labels = table(spark, sf_dir, "labels")
    return toxicity.fit(docs, labels, toxicity_categories(labels))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = fitted_toxicity(spark, docs, sf_dir)
    scored = toxicity.score(docs, chain)
    return scored.select("doc_id", *(F.round(f"p_{n}", 6).alias(f"p_{n}") for n in chain.names),
                         (F.col("p_toxic") >= toxicity.THRESHOLD).alias("toxic"))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, max_bits=2)


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    base_failed = ~quality_rules.passes("base")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failures",
                       base_failed.alias("base_failed"),
                       (~base_failed & quality_rules.passes(quality_rules.CURRENT)).alias("kept"))


ORACLES["op8_quality_rules"] = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS lines
  FROM documents),
win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c
  FROM (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS g
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8))),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM win WHERE c > 1) GROUP BY doc_id),
stut AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, words, unnest(range(2, len(words) + 1)) AS i FROM w)
         WHERE words[i] = words[i - 1] GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, coalesce(stut.n, 0) AS n_stutter,
         len(regexp_extract_all(text, '!')) AS n_exclaims
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN stut USING (doc_id)),
f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         CAST(CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
         + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_exclaims > n_words THEN 8 ELSE 0 END
         + CASE WHEN 100 * n_stutter > 40 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END
         + CASE WHEN word_chars > 20 * n_words THEN 64 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 128 ELSE 0 END
         AS BIGINT) AS failures
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures, base_failed, failures = 0 AS kept FROM f
"""


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                               public_tokenizers.PATTERN)


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=BENCHMARK_WINDOW)
    return scanned.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


# a word is a maximal run of word characters; every occurrence of every window covers n words
ORACLES["op10_decontaminate"] = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(words), {BENCHMARK_WINDOW}) AS n,
         array_to_string(words[i:i + least(len(words), {BENCHMARK_WINDOW}) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(words) - {BENCHMARK_WINDOW}, 0) + 2)) AS i FROM b WHERE len(words) > 0)),
n AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM w, n WHERE len(words) >= n)),
hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
               array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS s FROM hit GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"), k=5, percent=80)


def repeated_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's order of a document's n words: for a tenth of the ids the text goes on in a loop from word a."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.runs(table(spark, sf_dir, "documents"), rearranged=repeated_order)
    # exact order of length / period, ties to the smallest start, then period
    best = F.element_at(F.expr("""
        array_sort(runs, (x, y) -> CASE
            WHEN x.length * y.period > y.length * x.period THEN -1 WHEN x.length * y.period < y.length * x.period THEN 1
            WHEN x.start < y.start THEN -1 WHEN x.start > y.start THEN 1
            WHEN x.period < y.period THEN -1 ELSE 1 END)"""), 1)
    first = found.withColumn("best", F.when(F.size("runs") > 0, best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return first.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), "collapsed_sha256")


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), support=30, top=2000, inside_percent=80)


ORACLES["op13_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 5) t(k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
s AS (SELECT *, string_split(phrase, ' ') AS ws FROM f),
around AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS around
  FROM (SELECT *, unnest(range(1, CAST(k - m + 2 AS BIGINT))) AS i FROM s, range(2, 4) t(m) WHERE k > m) GROUP BY ALL),
c AS (SELECT s.* FROM s LEFT JOIN around USING (lang, phrase) WHERE k > 1 AND (around IS NULL OR 100 * around < 80 * a)),
cut AS (SELECT *, array_to_string(ws[1:j], ' ') AS first, array_to_string(ws[j + 1:], ' ') AS rest
        FROM (SELECT *, unnest(range(1, CAST(k AS BIGINT))) AS j FROM c)),
scored AS (
  SELECT cut.lang, cut.phrase, cut.a, j, x.a AS l, y.a AS r,
         CAST(CAST(2000000 AS HUGEINT) * cut.a // (x.a + y.a) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = first JOIN f y ON y.lang = cut.lang AND y.phrase = rest),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest JOIN total USING (lang) QUALIFY rank <= 2000
"""
