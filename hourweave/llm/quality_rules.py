"""Host-level quality rules, in DataFrame expressions only.

Every document is measured in one pass; rule failures are summed per host (the ``source``) with map-side
partials; each rule's host rates get an empirical beta prior (its mean and strength fitted by moments over all
hosts), so a host with few documents is judged mostly by what hosts are like; a host whose shrunk rate of any
rule passes the limit is refused, and its verdict is joined back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import store, table

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # percent of words in repeated windows
MAX_SYMBOLS = 10  # percent, symbols per word
MAX_DUP_LINES = 30  # percent of lines with a word
HOST_LIMIT = 0.5
SPACE = " \t\n\x0b\x0c\r"
_SPACE_RE = r"[\x20\x09-\x0D]+"
RULES = ("short", "repeated", "symbols", "dup_lines")


def measure(docs: DataFrame, host: str = "source", window: int = WINDOW) -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of every document.

    Windows are compared by 64-bit hashes of their words' 64-bit hashes, within one document.
    """
    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    inner = F.btrim("text", F.lit(SPACE))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    frame = (frame.withColumn("words", F.when(inner == "", F.array().cast("array<string>"))
                              .otherwise(F.split(inner, _SPACE_RE, -1)))
             .withColumn("lines", lines))
    n = F.size("words")
    frame = frame.select(
        "doc_id", "host", n.cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0), lambda a, w: a + F.char_length(w)).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    windows = F.when(F.col("n_words") < window, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size("hashes") - (window - 1)),
                    lambda i: F.xxhash64(F.slice("hashes", i, window))))
    frame = frame.withColumn("windows", windows).drop("hashes")
    # only documents with a repeated window go through the sort
    repeated = F.size("windows") > F.size(F.array_distinct("windows"))
    order = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    frame = frame.withColumn("order", F.when(repeated, order))
    at = F.filter(F.transform("order", lambda x, k: F.when(
        ((k > 0) & (F.get("order", k - 1)["h"] == x["h"])) | (F.get("order", k + 1)["h"] == x["h"]), x["i"])),
        lambda i: i.isNotNull())
    frame = frame.withColumn("at", F.array_sort(at)).drop("windows", "order")
    # each repeated window adds the words up to the next one's start, at most its own length
    covered = F.aggregate(
        F.transform("at", lambda i, k: F.least(F.coalesce(F.get("at", k + 1) - i, F.lit(window)), F.lit(window))),
        F.lit(0), lambda a, x: a + x)
    return frame.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def failures() -> dict[str, Column]:
    """Each rule's failure, from the measures."""
    n = F.col("n_words")
    return {"short": n < MIN_WORDS, "repeated": 100 * F.col("n_repeat_words") > MAX_REPEATED * n,
            "symbols": 100 * F.col("n_symbols") > MAX_SYMBOLS * n,
            "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines")}


def beta_priors(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """(mean, strength) of each rule's prior from (host, n, one count per rule), by weighted moments."""
    n, total = F.col("n").cast("double"), F.sum(F.col("n").cast("double"))
    first = hosts.agg(total.alias("n"), F.sum(n * n).alias("nn"), F.count(F.lit(1)).alias("h"),
                      *[F.sum(F.col(r).cast("double")).alias(r) for r in RULES]).first()
    if not first["n"]:
        return {r: (0.0, 1.0) for r in RULES}
    mean = {r: first[r] / first["n"] for r in RULES}
    spread = hosts.agg(*[F.sum(n * F.pow(F.col(r) / n - F.lit(mean[r]), 2)).alias(r) for r in RULES]).first()
    out, free = {}, first["h"] - 1
    for r in RULES:
        own = mean[r] * (1 - mean[r])
        room = own * (first["n"] - first["nn"] / first["n"] - free)
        # the share of variance between hosts; none can be told from one host or equal ones
        share = min(0.999, max(1e-6, (spread[r] - own * free) / room)) if room > 0 else 1e-6
        out[r] = (mean[r], 1 / share - 1)
    return out


def judge(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """The measures of every document with base_failed and kept.

    ``base_failed`` takes the rules short and repeated; ``kept`` is false for it and for documents of a refused
    host.  Edge cases: a null text has no words and fails; documents without a host are one host of their own;
    a null doc_id is kept as null; equal rows each get a row; an empty table gives none.
    """
    measures = store(measure(docs, host), "rule-measures")
    rules = failures()
    hosts = store(measures.groupBy("host").agg(F.count(F.lit(1)).alias("n"),
                                               *[F.count_if(rules[r]).alias(r) for r in RULES]), "rule-hosts")
    priors = beta_priors(hosts)
    rate = [(F.col(r) + F.lit(m * s)) / (F.col("n") + F.lit(s)) for r, (m, s) in priors.items()]
    verdict = hosts.select(F.col("host").alias("__host"), (F.greatest(*rate) > limit).alias("refused"))
    refused = verdict.filter("refused")
    base = rules["short"] | rules["repeated"]
    joined = measures.join(refused, F.col("host").eqNullSafe(F.col("__host")), "left")
    return joined.select(*measures.columns, base.alias("base_failed"),
                         (~base & F.col("refused").isNull()).alias("kept"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_BLANK = " || ".join(["' '", *(f"chr({k})" for k in range(9, 14))])
_RATE = """greatest(1e-6, least(0.999, CASE WHEN m * (1 - m) * (t - nn / t - h + 1) > 0
      THEN (s - m * (1 - m) * (h - 1)) / (m * (1 - m) * (t - nn / t - h + 1)) ELSE 1e-6 END))"""

ORACLE = f"""
WITH d AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF trim(x, {_BLANK}) <> ''] AS lines
  FROM documents),
win AS (
  SELECT doc_id, k, array_to_string(w[k:k + {WINDOW - 1}], ' ') AS win
  FROM d, unnest(range(1, len(w) - {WINDOW - 2})) AS u(k)),
rep AS (SELECT doc_id, k FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
cov AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM rep, unnest(range(k, k + {WINDOW})) AS u(p) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, host, len(w) AS n_words, CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN cov USING (doc_id)),
f AS (
  SELECT doc_id, host, unnest(['short', 'repeated', 'symbols', 'dup_lines']) AS rule,
         unnest([n_words < {MIN_WORDS}, 100 * n_repeat_words > {MAX_REPEATED} * n_words,
                 100 * n_symbols > {MAX_SYMBOLS} * n_words, 100 * n_dup_lines > {MAX_DUP_LINES} * n_lines]) AS failed
  FROM m),
hosts AS (SELECT host, rule, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE failed) AS DOUBLE) AS k FROM f GROUP BY ALL),
mean AS (SELECT rule, sum(k) / sum(n) AS m, sum(n) AS t, sum(n * n) AS nn, count(*) AS h FROM hosts GROUP BY rule),
prior AS (
  SELECT rule, m, 1 / {_RATE} - 1 AS strength
  FROM (SELECT rule, m, t, nn, h, sum(n * (k / n - m) * (k / n - m)) AS s
        FROM hosts JOIN mean USING (rule) GROUP BY ALL)),
refused AS (
  SELECT DISTINCT host FROM hosts JOIN prior USING (rule) WHERE (k + m * strength) / (n + strength) > {HOST_LIMIT})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words)
         AND NOT EXISTS (SELECT 1 FROM refused r WHERE r.host IS NOT DISTINCT FROM m.host) AS kept
FROM m
"""
