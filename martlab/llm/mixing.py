"""Mixing sources to target weights by hash thresholds: nothing is sorted and no document moves.

Every document has a fixed 60-bit hash of its id and text. A budget of words for a source becomes a threshold: the
documents whose hash is not above it are taken. Words are summed by source and the top bits of the hash; in the bucket
where the running sum crosses the budget, and only there, they are summed again by the next bits, until one hash value is
left at the boundary. That value is taken if the sum then is nearer to the budget. Budgets of one source are nested:
what a smaller one takes, a larger one takes too.

Targets: the sources, in order of their names by code point and null last, get the weights of a repeating list and share all words by
weight. A target stops at `repeats` times its source's words; the excess is shared again by weight until none is
above. A target of 2.3 times a source takes all its documents twice and those under the threshold of 0.3 once more.

Only DataFrame functions are used. The driver sees one weighted sum a round and the depth of the refinement.

Defined cases: a null or empty text has size 0 and is taken 0 words; a null source is a source of its own; equal rows have
equal hashes and are taken alike, as are rows that share id and text; the taken words of a source differ from its
target by half the words of the documents with the boundary hash at the most; further columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlab.operators.positions import Ordered

from .common import Scratch

WORD = r"[^\x20\x09-\x0D]+"  # fixed value of the contract
WEIGHTS = (1, 2, 3)
REPEATS = 3
LEVEL_BITS, LEVELS = 12, 5
HASH_BITS = LEVEL_BITS * LEVELS
WIDE = "decimal(38,0)"


def source_key(source: Column) -> Column:
    """Never null, in the order of the sources with null last."""
    return F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source))


def fixed_hash(doc_id: Column, text: Column, seed: str = "") -> Column:
    """60 bits that depend on id, text and seed only."""
    name = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def measured(docs: DataFrame, seed: str = "") -> DataFrame:
    """(doc_id, key, size, h): all that the mix needs of a document."""
    return docs.select(
        F.col("doc_id").cast("long"), source_key(F.col("source")).alias("key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        fixed_hash(F.col("doc_id"), F.col("text"), seed).alias("h"))


def share_out(scratch: Scratch, sources: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(key, words, target) of `sources` (key, words): all words, shared by weight under the caps."""
    ordered = Ordered(sources, "key")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("position") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = scratch.write(ordered.rows().select("key", "words", weight.cast("long").alias("weight"), (F.col("words") * repeats).alias("cap")))
    ordered.drop()
    total = table.agg(F.sum(F.col("words").cast(WIDE)).alias("t")).first()["t"] or 0
    # each round closes the sources whose share of what is left would be above their cap; the level only rises
    above, closed = F.lit(False), -1
    while True:
        row = table.agg(
            F.count(F.when(above, 1)).alias("n"), F.sum(F.when(above, F.col("cap").cast(WIDE))).alias("capped"),
            F.sum(F.when(~above, F.col("weight").cast(WIDE))).alias("open_weight")).first()
        left, open_weight = int(total - (row["capped"] or 0)), int(row["open_weight"] or 0)
        if row["n"] == closed or not open_weight:
            break
        closed = row["n"]
        above = F.col("cap").cast(WIDE) * F.lit(open_weight).cast(WIDE) < F.col("weight").cast(WIDE) * F.lit(left).cast(WIDE)
    share = (F.lit(left).cast(WIDE) * F.col("weight").cast(WIDE)).cast("double") / F.lit(float(open_weight or 1))
    return table.select("key", "words", F.when(above, F.col("cap").cast("double")).otherwise(share).alias("target"))


def thresholds(scratch: Scratch, sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """(key, budget, upto): for each of `budgets` (key, budget) the highest hash that it takes, -1 for none.

    `sized` (key, size, h) is summed by the first bits of `h`; from then on only rows of boundary buckets are read.
    """
    opened = scratch.write(budgets.select("key", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before")))
    rows, done = sized.select("key", "size", "h").where("size > 0"), None
    for level in range(1, LEVELS + 1):
        shift = HASH_BITS - LEVEL_BITS * level
        bucket = F.shiftright("h", shift)
        sums = (rows.groupBy("key", bucket.alias("bucket"))
                .agg(F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high")))
        # the buckets under one prefix, at most 2 ** LEVEL_BITS of them, add up in order
        inside = Window.partitionBy("key", "prefix").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        running = (sums.withColumn("prefix", F.shiftright("bucket", LEVEL_BITS))
                   .withColumn("upto", F.sum("words").over(inside)))
        met = (running.join(opened, ["key", "prefix"])
               .select("key", "budget", "bucket", "words", "low", "high", (F.col("before") + F.col("upto")).alias("after"))
               .where("after >= budget AND after - words < budget"))
        crossing = scratch.write(met.withColumn("before", F.col("after") - F.col("words")))
        single = F.lit(True) if level == LEVELS else F.col("low") == F.col("high")
        found = crossing.where(single).select(
            "key", "budget",
            F.when(F.col("after") - F.col("budget") <= F.col("budget") - F.col("before"), F.col("high"))
            .otherwise(F.col("low") - 1).alias("upto"))
        done = found if done is None else done.unionByName(found)
        opened = crossing.where(~single).select("key", "budget", F.col("bucket").alias("prefix"), "before")
        if level == LEVELS or opened.isEmpty():
            break
        wanted = opened.select("key", F.col("prefix").alias("b")).distinct()
        rows = scratch.write(rows.withColumn("b", bucket).join(wanted, ["key", "b"], "left_semi").drop("b"))
    return scratch.write(done)


def mix(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS, seed: str = "") -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of `docs` (doc_id, source, text)."""
    scratch = Scratch(spark, "mix")
    sized = scratch.write(measured(docs, seed))
    sources = scratch.write(sized.groupBy("key").agg(F.sum("size").alias("words")))
    shared = scratch.write(share_out(scratch, sources, weights, repeats))
    whole = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("long")
    plan = shared.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("words"))
    limits = thresholds(scratch, sized, plan.where("rest > 0").select("key", F.col("rest").alias("budget")))
    rule = plan.join(limits.select("key", "upto"), "key", "left").select(
        "key", F.col("words").alias("source_size"), "target", "whole", F.coalesce("upto", F.lit(-1)).alias("upto"))
    return sized.join(rule, "key").select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * (F.col("whole") + F.when(F.col("h") <= F.col("upto"), 1).otherwise(0))).alias("taken"))


def op11_hash_threshold_mix(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, each with the words that the mix takes of it."""
    return mix(spark, spark.read.parquet(f"{folder}/documents.parquet"))


OP11_SQL = """
WITH sized AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || left(md5(':' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 15))::BIGINT AS h
  FROM documents),
sources AS (
  SELECT key, sum(size)::BIGINT AS words, [1, 2, 3][((row_number() OVER (ORDER BY key COLLATE "C") - 1) % 3 + 1)::INTEGER] AS weight
  FROM sized GROUP BY key),
caps AS (
  SELECT *, sum(words) OVER () AS total,
         coalesce(sum(3 * words) OVER (ORDER BY 3.0::DOUBLE * words / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(weight) OVER (ORDER BY 3.0::DOUBLE * words / weight, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM sources),
level AS (
  SELECT arg_max(total - capped, open_weight) AS remaining, max(open_weight) AS open_weight FROM caps
  WHERE 3 * words * open_weight >= (total - capped) * weight),
targets AS (
  SELECT key, words, least(3 * words, (remaining * weight)::DOUBLE / level.open_weight::DOUBLE)::DOUBLE AS target FROM caps, level),
plan AS (SELECT *, CASE WHEN words > 0 THEN floor(target / words) ELSE 0 END::BIGINT AS whole FROM targets),
running AS (
  SELECT key, h, sum(size) OVER (PARTITION BY key ORDER BY h) AS after,
         sum(size) OVER (PARTITION BY key, h) AS held FROM sized WHERE size > 0),
upto AS (
  SELECT key, max(CASE WHEN after - (target - whole * words) <= (target - whole * words) - (after - held) THEN h ELSE h - 1 END) AS upto
  FROM running JOIN plan USING (key) WHERE target > whole * words AND after - held < target - whole * words GROUP BY key)
SELECT doc_id, size, words AS source_size, target,
       (size * (whole + CASE WHEN h <= coalesce(upto, -1) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized JOIN plan USING (key) LEFT JOIN upto USING (key)
"""
