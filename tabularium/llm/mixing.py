"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its target share of the whole divided by its present share. Each document gets the
Poisson count at its own hash-seeded uniform number (inversion of the distribution function), is emitted that many
times, and the copies are dealt to random partitions and sorted by a random key: a global shuffle without sampling.

A source's rate meets its rows by broadcast where the source holds over a thousandth of all rows (such sources are fewer
than a thousand), and by shuffle otherwise, at every size. Nothing but the rate travels: the count comes from summing the
distribution's terms at the row, in time in proportion to the copies.

Defined results: a null source is a source; a source with no target weight has rate 0, and so have a null, NaN or
negative weight; null text counts as no characters; a null doc_id hashes as the empty text; repeated rows draw the same
count; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT_KEYS, materialise


def uniform(doc_id: Column, salt: Column) -> Column:
    """A number in [0, 1) from 13 hexadecimal digits of an MD5 digest."""
    text = F.concat_ws(":", salt.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(16**13)


def poisson_inverse(rate: Column, u: Column) -> Column:
    """How many of P(X <= 0), P(X <= 1), ... are at or below ``u``; the terms left out are below any uniform's step."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    # Logs keep large rates from underflowing.
    begin = F.struct((-rate).alias("log_p"), F.exp(-rate).alias("sum"), (F.exp(-rate) <= u).cast("int").alias("n"))

    def step(acc: Column, k: Column) -> Column:
        log_p = acc["log_p"] + F.ln(rate) - F.ln(k.cast("double"))
        total = acc["sum"] + F.exp(log_p)
        return F.struct(log_p.alias("log_p"), total.alias("sum"), (acc["n"] + (total <= u).cast("int")).alias("n"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), begin, step, lambda acc: acc["n"])).otherwise(0)


def rates(docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.5, budget: float = 1.0) -> DataFrame:
    """(source, rate, rows). ``weights``: (source, weight); without, shares are flattened to the power ``temperature``.

    The expected size of the mixture is ``budget`` times the input's characters.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.length(F.coalesce(F.col("text").cast("string"), F.lit("")))).cast("double").alias("size"), F.count("*").alias("rows"))
    sizes = materialise(sizes, "sizes")
    if weights is None:
        target = sizes.withColumn("weight", F.pow("size", F.lit(temperature)))
    else:
        good = F.when((F.col("weight") > 0) & ~F.isnan(F.col("weight").cast("double")), F.col("weight").cast("double"))
        named = weights.groupBy(F.col("source").alias("named")).agg(F.max(good).alias("weight"))
        target = sizes.join(named, F.col("source").eqNullSafe(F.col("named")), "left").select("source", "size", "rows", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    total = target.agg(F.sum("size").alias("t"), F.sum(F.when(F.col("size") > 0, F.col("weight"))).alias("w")).first()
    t, w = total["t"] or 0.0, total["w"] or 1.0
    rate = F.when(F.col("size") > 0, F.col("weight") / F.lit(w) * F.lit(t) * F.lit(budget) / F.col("size")).otherwise(0.0)
    return target.select("source", F.round(rate, 9).alias("rate"), "rows")


def mix(docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.5, budget: float = 1.0, seed: int = 17, tell: bool = True) -> DataFrame:
    """``docs`` (doc_id, text, source, more) repeated and shuffled; ``tell`` adds copy (from 0), n_copies and rate.

    Extra columns with those names are replaced when ``tell`` is set.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))  # null is a name of its own
    told = materialise(rates(docs, weights, temperature, budget).select(name.alias("_mix_source"), F.col("rate").alias("_mix_rate"), "rows"), "rates")
    rows = told.agg(F.sum("rows").alias("n")).first()["n"] or 0
    hot = told.where(F.col("rows") * HOT_KEYS > rows).drop("rows")
    named = docs.withColumn("_mix_source", name)
    often = named.join(F.broadcast(hot), "_mix_source")
    rest = named.join(F.broadcast(hot), "_mix_source", "left_anti").join(told.where(F.col("rows") * HOT_KEYS <= rows).drop("rows").hint("merge"), "_mix_source")
    counted = often.unionByName(rest).withColumn("_mix_n", poisson_inverse(F.col("_mix_rate"), uniform(F.col("doc_id"), F.lit(seed)))).where("_mix_n > 0")
    copies = counted.drop("_mix_source").withColumn("_mix_copy", F.explode(F.sequence(F.lit(0), F.col("_mix_n") - 1)))
    key = uniform(F.col("doc_id"), F.concat(F.lit(f"order{seed}-"), F.col("_mix_copy").cast("string")))
    # Rows that were read by different tasks part even where one id or text is very common.
    dealt = copies.withColumn("_mix_key", key).withColumn("_mix_part", F.spark_partition_id())
    dealt = dealt.repartition(F.xxhash64("_mix_key", "_mix_part")).sortWithinPartitions("_mix_key")
    if tell:
        dealt = dealt.withColumns({"copy": F.col("_mix_copy"), "n_copies": F.col("_mix_n"), "rate": F.col("_mix_rate")})
    return dealt.drop("_mix_key", "_mix_copy", "_mix_n", "_mix_rate", "_mix_part")
