"""Temperature mixing: source shares to an exponent, found by bisection, realised as budgeted block permutations.

A source with token share p gets weight p^a / sum(p^a); a = 1 keeps the shares, a = 0
levels them. The exponent is the smallest (most level) one in [0, 1] that meets what is
asked: an entropy of at most ``target_entropy`` (share of log(number of sources)), and
a repetition of at most ``repetition_limit`` epochs. The exponent is bisected; each pass
over the table of sources settles four halvings at once, so no list of sources comes to
the driver.

Realisation: a source of T tokens and weight w owes w * budget tokens. Its documents are
dealt by hash to blocks, and in every epoch the blocks, and the documents inside a block,
stand in an order drawn from the seed. Whole blocks are taken until the budget is
reached, then documents of the last block, as long as they begin within the budget.
Without a budget, the smallest one that takes every document at least once is used.
Sums run over blocks first: a source with a third of all rows is many blocks.

``mix_position`` in [0, 1) interleaves the sources in proportion: sort by it to train.
Tokens are words. Nulls: a null text has no words; documents without words come once, at
position 0; a null source is a source of its own. If some ids are null or shared, rows are
told apart by a number, so each is taken by itself. An empty table gives an empty mix. Input
columns travel in one struct.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelcat.llm.common import packed, table, whole, words_of
from reelcat.session import stage_table

HALVINGS = 4
PASSES = 10
#: Hexadecimal digits of a block's draw by which blocks are summed first.
DIGITS = 3


@dataclass(frozen=True)
class Mix:
    target_entropy: float | None = 0.98
    repetition_limit: float | None = 3.0
    budget_tokens: int | None = None
    block_tokens: int = 20_000
    seed: str = "mix"


def exponent(sources: DataFrame, mix: Mix) -> float:
    """The smallest exponent in [0, 1] under the limits, to 40 halvings; 1 if none meets them."""
    share = F.col("tokens") / F.col("all_tokens")
    low, high = 0.0, 1.0
    n_sources = sources.count()
    if n_sources <= 1:
        return 1.0
    for _ in range(PASSES):
        cuts = [low + (high - low) * k / (1 << HALVINGS) for k in range(1 << HALVINGS)]
        wanted = []
        for k, a in enumerate(cuts):
            powered = F.pow(share, F.lit(a))
            wanted += [F.sum(powered).alias(f"z{k}"), F.sum(powered * F.log(share)).alias(f"l{k}"),
                       F.max(F.pow(share, F.lit(a - 1))).alias(f"r{k}"), F.min(F.pow(share, F.lit(a - 1))).alias(f"s{k}"),
                       F.max(F.col("all_tokens")).alias(f"t{k}")]
        row = sources.agg(*wanted).first()
        step = (high - low) / (1 << HALVINGS)
        for k, a in enumerate(cuts):
            if _meets(row[f"z{k}"], row[f"l{k}"], row[f"r{k}"], row[f"s{k}"], row[f"t{k}"], a, n_sources, mix):
                if k == 0 and a == 0.0:
                    return 0.0
                low, high = a - step, a
                break
        else:
            low = cuts[-1]
    return round(high, 9)


def _meets(z, logs, most, least, total, a, n_sources, mix: Mix) -> bool:
    entropy = math.log(z) - a * logs / z
    # tokens owed / tokens there: budget * p^a / z / (p * total)
    repetition = most / least if mix.budget_tokens is None else most * mix.budget_tokens / (z * total)
    return ((mix.target_entropy is None or entropy <= mix.target_entropy * math.log(n_sources) + 1e-12)
            and (mix.repetition_limit is None or repetition <= mix.repetition_limit + 1e-12))


def _drawn(*parts) -> Column:
    return F.md5(F.concat_ws("|", *parts))


def mixed(docs: DataFrame, mix: Mix = Mix(), key: str = "doc_id", text: str = "text", source: str = "source",
          tokens: str | None = None) -> DataFrame:
    """(row, source, tokens, epoch, block, weight, mix_position): a row for each time a document is taken.

    ``tokens`` names a column of token counts; without it words are counted. The plan is
    made from (source, id, tokens) alone; the rows themselves are shuffled once, at the end.
    """
    counted = F.size(words_of(whole(F.col(f"row.`{text}`")))) if tokens is None else F.coalesce(F.col(f"row.`{tokens}`"), F.lit(0))
    df = packed(docs).select("row", F.col(f"row.`{source}`").cast("string").alias("source"), counted.cast("long").alias("tokens"))
    # null beside "" and "null"
    df = df.withColumns({"named": F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")),
                         "ident": F.coalesce(F.col(f"row.`{key}`").cast("string"), F.lit(""))})
    narrow = stage_table(df.groupBy("named", "ident").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("copies")), "mix-tokens")
    if narrow.where("copies > 1").limit(1).count():  # ids that are null or shared don't name one row: rows are numbered, once
        number = F.concat_ws("|", "ident", F.monotonically_increasing_id().cast("string"))
        df = stage_table(df.withColumn("ident", number), "mix-numbered")
        narrow = df
    narrow = narrow.select("named", "ident", "tokens").where("tokens > 0")
    sources = stage_table(narrow.groupBy("named").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    sources = sources.withColumn("all_tokens", F.lit(total).cast("long"))
    powered = F.pow(F.col("tokens") / F.col("all_tokens"), F.lit(exponent(sources, mix)))
    z, scale = sources.agg(F.sum(powered), F.max(F.col("tokens") / powered)).first()
    if mix.budget_tokens is None:  # the smallest budget owing each source its own tokens
        owed = F.floor(powered * F.lit(scale or 0.0) + F.lit(1e-6))
    else:
        owed = F.floor(powered * F.lit(mix.budget_tokens / (z or 1.0)) + F.lit(1e-6))
    sources = sources.select(F.col("named").alias("s_named"), F.col("tokens").alias("source_tokens"),
                             F.round(powered / F.lit(z or 1.0), 9).alias("weight"), owed.cast("long").alias("owed"),
                             F.ceil(F.col("tokens") / mix.block_tokens).cast("long").alias("n_blocks"))
    number = F.conv(F.substring(_drawn(F.lit(mix.seed), F.lit("block"), "ident"), 1, 15), 16, 10).cast("long")
    narrow = narrow.join(sources, F.col("named") == F.col("s_named")).withColumn("block", F.pmod(number, "n_blocks"))
    # a source's blocks over its epochs, and the tokens taken ahead of each
    blocks = narrow.groupBy("named", "block").agg(
        F.sum("tokens").alias("block_tokens"), F.max("owed").alias("owed"), F.max("source_tokens").alias("source_tokens"))
    last_epoch = F.floor((F.col("owed") - 1) / F.col("source_tokens")).cast("long")
    blocks = blocks.where("owed > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last_epoch)))
    drawn = _drawn(F.lit(mix.seed), F.lit("order"), "named", F.col("epoch").cast("string"), F.col("block").cast("string"))
    # summed by the first digits drawn, then inside them: no task gets all blocks of a source
    blocks = blocks.withColumn("drawn", drawn).withColumn("digits", F.substring("drawn", 1, DIGITS))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    groups = blocks.groupBy("named", "epoch", "digits").agg(F.sum("block_tokens").alias("group_tokens"))
    groups = groups.withColumn("earlier", F.coalesce(F.sum("group_tokens").over(before("named", "epoch").orderBy("digits")), F.lit(0))).drop("group_tokens")
    inside = F.coalesce(F.sum("block_tokens").over(before("named", "epoch", "digits").orderBy("drawn", "block")), F.lit(0))
    blocks = blocks.withColumn("inside", inside).join(groups, ["named", "epoch", "digits"])
    ahead = F.col("earlier") + F.col("inside") + F.col("epoch") * F.col("source_tokens")
    blocks = blocks.withColumn("ahead", ahead).where("ahead < owed").select(
        F.col("named").alias("b_named"), F.col("block").alias("b_block"), "epoch", "ahead")
    taken = narrow.join(blocks, (F.col("named") == F.col("b_named")) & (F.col("block") == F.col("b_block")))
    inside = Window.partitionBy("named", "epoch", "block").orderBy(
        _drawn(F.lit(mix.seed), F.lit("document"), F.col("epoch").cast("string"), "ident"), "ident").rowsBetween(Window.unboundedPreceding, -1)
    taken = taken.withColumn("begins", F.col("ahead") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).where("begins < owed")
    times = taken.groupBy(F.col("named").alias("t_named"), F.col("ident").alias("t_ident")).agg(
        F.collect_list(F.struct("epoch", "block", "weight", F.round(F.col("begins") / F.col("owed"), 9).alias("mix_position"))).alias("times"))
    once = F.array(F.struct(F.lit(0).cast("long").alias("epoch"), F.lit(0).cast("long").alias("block"), F.lit(0.0).alias("weight"), F.lit(0.0).alias("mix_position")))
    out = df.join(times, (F.col("named") == F.col("t_named")) & (F.col("ident") == F.col("t_ident")), "left")
    out = out.withColumn("time", F.explode(F.when(F.col("tokens") == 0, once).otherwise(F.col("times"))))
    return out.select("row", "source", "tokens", "time.epoch", "time.block", "time.weight", "time.mix_position")


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixed(docs).select("row.doc_id", "source", "tokens", "epoch", "block", "weight", "mix_position")


def _oracle(mix: Mix = Mix(), halvings: int = HALVINGS, passes: int = PASSES) -> str:
    """The query's SQL for DuckDB, for a mix without a budget. Ids are taken to be unique."""
    n, seed = 1 << halvings, mix.seed
    cuts = ["c0 AS (SELECT 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi)"]
    for k in range(passes):
        cuts.append(f"""g{k} AS (SELECT lo + (hi - lo) * i / {n} AS a, (hi - lo) / {n} AS step, lo, hi FROM c{k}, range({n}) AS r(i)),
m{k} AS (SELECT a, any_value(step) AS step, any_value(lo) AS lo, any_value(hi) AS hi,
    ln(sum(pow(p, a))) - a * sum(pow(p, a) * ln(p)) / sum(pow(p, a)) <= {mix.target_entropy} * ln(count(*)) + 1e-12
    AND max(pow(p, a - 1)) / min(pow(p, a - 1)) <= {mix.repetition_limit} + 1e-12 AS ok FROM g{k}, p GROUP BY a),
c{k + 1} AS (SELECT CASE WHEN bool_or(ok) THEN greatest(min(a) FILTER (ok) - any_value(step), any_value(lo)) ELSE max(a) END AS lo,
    coalesce(min(a) FILTER (ok), any_value(hi)) AS hi FROM m{k})""")
    return f"""
WITH t AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens,
             coalesce('=' || source, '-') AS named, coalesce(doc_id::VARCHAR, '') AS ident FROM documents),
s0 AS (SELECT named, sum(tokens)::BIGINT AS source_tokens FROM t WHERE tokens > 0 GROUP BY named),
p AS (SELECT named, source_tokens, source_tokens / (SELECT sum(source_tokens) FROM s0) AS p FROM s0),
{", ".join(cuts)},
e AS (SELECT CASE WHEN (SELECT count(*) FROM s0) = 1 THEN 1.0 ELSE round(hi, 9) END AS a FROM c{passes}),
w AS (SELECT named, source_tokens, pow(p, a) AS q FROM p, e),
s AS (SELECT named, source_tokens, round(q / (SELECT sum(q) FROM w), 9) AS weight,
        floor(q * (SELECT max(source_tokens / q) FROM w) + 1e-6)::BIGINT AS owed, ceil(source_tokens / {mix.block_tokens})::BIGINT AS n_blocks FROM w),
d AS (SELECT t.*, source_tokens, weight, owed, ('0x' || substr(md5('{seed}|block|' || ident), 1, 15))::BIGINT % n_blocks AS block
      FROM t JOIN s USING (named) WHERE tokens > 0),
b0 AS (SELECT named, block, sum(tokens) AS bt, any_value(owed) AS owed, any_value(source_tokens) AS st FROM d GROUP BY ALL),
b1 AS (SELECT *, unnest(range(0, (owed - 1) // st + 1)) AS epoch FROM b0),
b AS (SELECT named, block, epoch, owed, epoch * st + coalesce(sum(bt) OVER (PARTITION BY named, epoch
        ORDER BY md5('{seed}|order|' || named || '|' || epoch || '|' || block), block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM b1),
k AS (SELECT doc_id, source, tokens, epoch, block, weight, d.owed, ahead + coalesce(sum(tokens) OVER (PARTITION BY named, epoch, block
        ORDER BY md5('{seed}|document|' || epoch || '|' || ident), ident ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
      FROM d JOIN b USING (named, block) WHERE ahead < b.owed)
SELECT doc_id, source, tokens, epoch, block, weight, round(begins / owed, 9) AS mix_position FROM k WHERE begins < owed
UNION ALL SELECT doc_id, source, tokens, 0, 0, 0.0, 0.0 FROM t WHERE tokens = 0
"""


ORACLE = _oracle()
