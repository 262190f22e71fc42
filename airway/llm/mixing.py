"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its target share of the mixture over its share of the
corpus. Every document draws a Poisson count of that mean by inverting the distribution
at a number hashed from the seed and its id, is repeated that often, and the copies are
dealt out in an order hashed from the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airway.llm.batches import fresh
from airway.sources.staging import Work, session_work

SEED = "mix-1"
# Target share of a source: its characters to this power. 1 keeps the corpus as it is, 0 makes sources equal.
POWER = 0.5
# A count of a larger mean is the sum of draws of at most this mean, each with its own number.
PART = 16.0
# Steps of the inversion; beyond them lies less than 2 ** -53 of a distribution of mean 16.
STEPS = 80


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 13 hexadecimal digits of an MD5 hash."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(2**52))


def poisson_table(mean: Column) -> Column:
    """P(X <= k) for k = 0 .. STEPS, as an array."""
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))
    steps = F.sequence(F.lit(1), F.lit(STEPS))
    grown = F.aggregate(
        steps,
        start,
        lambda s, k: F.struct(
            (s["p"] * mean / k).alias("p"), F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * mean / k)).alias("cdf")
        ),
    )
    return grown["cdf"]


def _at_or_below(table: Column, u: Column) -> Column:
    return F.size(F.filter(table, lambda c: c <= u))


def rates(docs: DataFrame, source: str, text: str, targets: dict[str, float] | None, epochs: float, work: Work) -> DataFrame:
    """``_source, rate`` of every source; runs a job. Without ``targets`` the share of a
    source goes by ``POWER`` of its characters; with them it is given, others get none."""
    sizes = docs.groupBy(F.col(source).alias("_source")).agg(F.sum(F.coalesce(F.length(text), F.lit(0))).alias("chars"))
    if targets is None:
        wish = F.pow(F.col("chars").cast("double"), F.lit(POWER))
    else:
        given = F.create_map(*[F.lit(x) for name, share in targets.items() for x in (name, float(share))])
        wish = F.when(F.col("chars") > 0, F.coalesce(given[F.col("_source")], F.lit(0.0))).otherwise(0.0)
    sizes = work.stage(sizes.withColumn("wish", wish), "sources")
    chars, wishes = sizes.agg(F.sum("chars"), F.sum("wish")).first()
    if not chars or not wishes:
        return sizes.select("_source", F.lit(0.0).alias("rate"))
    rate = F.col("wish") / F.lit(wishes) * F.lit(float(chars)) * F.lit(epochs) / F.col("chars")
    return sizes.select("_source", F.when(F.col("chars") > 0, rate).otherwise(0.0).alias("rate"))


def mix_sources(
    docs: DataFrame,
    source: str = "source",
    id_column: str = "doc_id",
    text: str = "text",
    targets: dict[str, float] | None = None,
    epochs: float = 1.0,
    seed: str = SEED,
    work: Work | None = None,
) -> DataFrame:
    """Rows of ``docs`` repeated to the target shares of sources, counted in characters,
    in a global random order; runs a job for the rates. Adds ``copy`` (1 and up) and
    ``place`` (the hashed number that orders the rows) in place of columns so named.

    The mixture holds about ``epochs`` times the corpus's characters. Null is a source of
    its own. A source without characters has rate 0, so its rows are left out; null and
    empty texts of other sources take part. Rows that are alike in id draw alike, so
    repeated rows repeat alike; rows without id draw by their text."""
    work = work or session_work(docs.sparkSession)
    origin, rate, parts, rest, full, count = fresh(docs, "_source", "_rate", "_parts", "_rest", "_full", "_count")
    table = rates(docs, source, text, targets, epochs, work).withColumnsRenamed({"_source": origin, "rate": rate})
    whole = F.floor(F.col(rate) / F.lit(PART)).cast("int")
    table = table.withColumn(parts, whole).withColumn(rest, poisson_table(F.col(rate) - whole * F.lit(PART)))
    table = table.withColumn(full, F.when(whole > 0, poisson_table(F.lit(PART))).otherwise(F.array().cast("array<double>")))
    # One row a source, staged: only its true size lets Spark send it to the documents.
    table = work.stage(table, "rates")
    key = F.coalesce(F.col(id_column).cast("string"), F.md5(text), F.lit(""))
    joined = docs.join(table, F.col(source).eqNullSafe(F.col(origin)))
    first = _at_or_below(F.col(rest), uniform(F.lit(seed), F.lit("0"), key))
    more = F.aggregate(
        F.sequence(F.lit(0), F.col(parts)),
        F.lit(0),
        lambda n, i: n + F.when(i > 0, _at_or_below(F.col(full), uniform(F.lit(seed), i.cast("string"), key))).otherwise(0),
    )
    counted = joined.withColumn(count, first + F.when(F.col(parts) > 0, more).otherwise(0)).where(F.col(count) > 0)
    kept = [F.col(c) for c in docs.columns if c.lower() not in ("copy", "place")]
    copies = counted.select(*kept, key.alias(origin), F.explode(F.sequence(F.lit(1), F.col(count))).alias("copy"))
    place = uniform(F.lit(seed), F.lit("order"), F.col("copy").cast("string"), F.col(origin))
    placed = copies.withColumn("place", place).drop(origin)
    return placed.repartition("place", "copy").sortWithinPartitions("place", "copy")
