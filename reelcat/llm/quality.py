"""Host-level quality rules: rule failures by domain, shrunk with an empirical beta prior.

Each document is measured once (JVM expressions only). Failures of any rule are
counted by host, the rates are shrunk towards a beta prior fitted to all hosts by
the method of moments, and the host's verdict is joined back: on a host whose
shrunk rate exceeds ``max_host_rate`` every document that fails any rule goes;
elsewhere only the documents that fail a hard rule do. A document that fails no
rule stays wherever it stands.

Nulls: a null text has no words (and so fails); a null host is a host of its own.
An empty table gives an empty result. Equal rows get equal verdicts. Input columns
travel in one struct, so extra or clashing names don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelcat.llm.common import WHITESPACE, packed, whole, words_of
from reelcat.session import stage_table

SYMBOLS = "#*$%&|<>"
WINDOW = 5
METRICS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _long(c: Column) -> Column:
    return c.cast("long")


def measured(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """(row, host, the METRICS) for each document; one narrow pass, no shuffle."""
    df = packed(docs).withColumn("host", F.col(f"row.`{host}`").cast("string"))
    df = df.withColumn("t", whole(F.col(f"row.`{text}`")))
    df = df.withColumns({"w": words_of(F.col("t")),
                         "lines": F.filter(F.split("t", "\n", -1), lambda x: x.rlike("[^ \\x09-\\x0D]"))})
    df = df.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    last = F.size("w") - WINDOW
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)]))
    df = df.withColumn("g", hashed)
    df = df.withColumn("some", F.size(F.array_distinct("g")) < F.size("g"))
    # Windows whose hashes all differ do all differ; the others are compared as text.
    named = F.array_sort(F.transform(starts, lambda i: F.struct(
        F.concat_ws(" ", *[F.get("w", i + k) for k in range(WINDOW)]).alias("g"), i.alias("i"))))
    df = df.withColumn("s", F.when(F.col("some"), named))
    twice = F.filter("s", lambda x, k: (F.coalesce(F.get("s", k - 1)["g"] == x["g"], F.lit(False)))
                     | (F.coalesce(F.get("s", k + 1)["g"] == x["g"], F.lit(False))))
    df = df.withColumn("p", F.when(F.col("some"), F.array_sort(F.transform(twice, lambda x: x["i"]))))
    covered = F.aggregate(
        F.transform("p", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("p", k + 1) - x, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    return df.select(
        "row", "host",
        _long(F.size("w")).alias("n_words"),
        _long(F.length(F.translate("t", WHITESPACE, ""))).alias("word_chars"),
        _long(F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).alias("n_symbols"),
        _long(F.size("lines")).alias("n_lines"),
        _long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _long(F.when(F.col("some"), covered).otherwise(F.lit(0))).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rule_failed() -> Column:
    """Any rule: the hard ones, symbols, repeated lines, or a mean word length outside 2 to 15."""
    return (base_failed() | (10 * F.col("n_symbols") > F.col("n_words")) | (10 * F.col("n_dup_lines") > 3 * F.col("n_lines"))
            | (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")))


def host_verdicts(m: DataFrame, max_host_rate: float = 0.5) -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate, bad_host): one row per host.

    The prior's mean is the mean of the hosts' rates, its strength follows from their
    variance (beta, method of moments) and is 1 pseudo-document at least. Failures are
    partly summed before the shuffle, so a host with a third of the rows costs no more.
    """
    hosts = m.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(rule_failed().cast("long")).alias("n_failed"))
    hosts = stage_table(hosts, "host-counts")
    rate = F.col("n_failed") / F.col("n_docs")
    mean, var = hosts.agg(F.avg(rate), F.var_pop(rate)).first()  # two numbers
    mean = mean or 0.0
    strength = max(1.0, mean * (1 - mean) / var - 1) if var else 1.0
    shrunk = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    return hosts.select("*", shrunk.alias("shrunk_rate"), (F.round(shrunk, 9) > max_host_rate).alias("bad_host"))


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", keep_text: bool = True,
                  max_host_rate: float = 0.5) -> DataFrame:
    """(row, the METRICS, base_failed, bad_host, kept) for every document.

    The measures are staged once (without the text unless ``keep_text``), so that the
    counts by host and the join back read them instead of the texts again.
    """
    m = measured(docs, text, host)
    if not keep_text:
        m = m.withColumn("row", F.struct(*[F.col(f"row.`{c}`") for c in docs.columns if c != text]))
    m = stage_table(m, "quality")
    verdicts = host_verdicts(m, max_host_rate).select(F.col("host").alias("v_host"), "bad_host")
    out = m.join(verdicts, m["host"].eqNullSafe(F.col("v_host")), "left")
    return out.select("row", *METRICS, base_failed().alias("base_failed"), "bad_host",
                      (~base_failed() & ~(F.col("bad_host") & rule_failed())).alias("kept"))


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    out = quality_rules(docs, keep_text=False)
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "bad_host")


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT r, i, list_slice(w, i, i + 4) AS g FROM w, unnest(range(1, len(w) - 3)) AS u(i)),
d AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
c AS (SELECT r, least(5, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 5)) AS k FROM d),
n AS (SELECT r, sum(k)::BIGINT AS n_repeat_words FROM c GROUP BY r),
m AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(l) AS n_lines,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN n USING (r)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
a AS (SELECT *, base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines OR word_chars < 2 * n_words
             OR word_chars > 15 * n_words AS any_failed FROM f),
h AS (SELECT source, count(*) AS n, sum(any_failed::BIGINT) AS k FROM a GROUP BY source),
p AS (SELECT avg(k / n) AS mean, var_pop(k / n) AS var FROM h),
s AS (SELECT mean, CASE WHEN var > 0 THEN greatest(1.0, mean * (1 - mean) / var - 1) ELSE 1.0 END AS strength FROM p),
v AS (SELECT source, round((k + mean * strength) / (n + strength), 9) > 0.5 AS bad_host FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (bad_host AND any_failed) AS kept, bad_host
FROM a JOIN v ON a.source IS NOT DISTINCT FROM v.source
"""
