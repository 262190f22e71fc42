"""Set difference, keyed upsert, feature assembly and frequency filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airway.functions.records import json_map, json_merge_patch
from airway.operators.cleaning import one_per_key
from airway.operators.joining import lookup_join
from airway.sources.staging import staged


def difference(new: DataFrame, old: DataFrame) -> DataFrame:
    """Distinct rows of ``new`` that ``old`` lacks (EXCEPT DISTINCT). One grouping
    pass: copies merge before the shuffle, nulls compare equal."""
    columns = new.columns
    both = new.withColumn("_stored", F.lit(0)).unionByName(old.select(*columns).withColumn("_stored", F.lit(1)))
    return both.groupBy(*columns).agg(F.max("_stored").alias("_stored")).where(F.col("_stored") == 0).drop("_stored")


def same_key(keys: list[str], prefix: str) -> Column:
    """Key columns equal those carrying the prefix; null equals null, so that a
    repeated upsert finds its own rows."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def upsert(new: DataFrame, old: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """``old`` with rows of ``new`` replacing those of the same key; among new
    rows of one key the last by ``order`` stays."""
    latest = one_per_key(new.select(*old.columns), keys, order, last=True)
    replaced = latest.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    kept = lookup_join(old, replaced, same_key(keys, "_new_"), "left_anti", size_of=new)
    return kept.select(*old.columns).unionByName(latest)


def upsert_json(new: DataFrame, old: DataFrame, keys: list[str], payload: str, order: list[str] | None = None) -> DataFrame:
    """Upsert that merges the JSON payload on a key conflict: stored members
    win, new members are added, other columns keep their stored value."""
    latest = one_per_key(new.select(*old.columns), keys, order, last=True)
    fresh = latest.select(*[F.col(c).alias(f"_new_{c}") for c in old.columns], F.lit(True).alias("_is_new"))
    joined = old.withColumn("_is_old", F.lit(True)).join(fresh, same_key(keys, "_new_"), "full")

    def pick(c: str) -> Column:
        stored = F.col(c)
        if c == payload:
            stored = F.when(F.col("_is_new"), json_merge_patch(f"_new_{c}", c)).otherwise(stored)
        return F.when(F.col("_is_old"), stored).otherwise(F.col(f"_new_{c}")).alias(c)

    return joined.select(*[pick(c) for c in old.columns])


def merge_payloads(left: DataFrame, right: DataFrame, keys: list[str], payload: str, combine) -> DataFrame:
    """Inner join on the keys with both JSON payloads combined into one."""
    other = right.select(*keys, F.col(payload).alias("_other"))
    return left.join(other, keys).withColumn(payload, combine(F.col(payload), F.col("_other"))).drop("_other")


def explode_payload(df: DataFrame, keep: list[str], payload: str = "data") -> DataFrame:
    """One row per JSON member: ``keep..., key, value`` (text)."""
    return df.select(*keep, F.explode(json_map(payload)).alias("key", "value"))


def assemble(features: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of feature sets on shared keys, as one union and one
    grouping. Each set is unique on the keys and owns its feature columns."""
    columns = [c for f in features for c in f.columns if c not in keys]
    if len(columns) != len(set(columns)):
        raise ValueError("a feature column occurs in two sets")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), features)
    return rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])


def frequent_keys(df: DataFrame, key: str, more_than: int) -> DataFrame:
    """Keys with more than ``more_than`` rows; a null key never counts."""
    return df.groupBy(key).agg(F.count(key).alias("_n")).where(F.col("_n") > more_than).select(key)


def rows_of_frequent_keys(df: DataFrame, key: str, more_than: int, counted: DataFrame | None = None) -> DataFrame:
    """Rows whose key is frequent in ``counted`` (by default in ``df`` itself).

    The keys are staged first: they are few, and only their true size lets the
    rows stay where they are instead of being shuffled by key."""
    keys = staged(frequent_keys(df if counted is None else counted, key, more_than), "frequent")
    return lookup_join(df, keys, key, "left_semi")


def latest_rows(df: DataFrame, by: str, time: str) -> DataFrame:
    """Rows holding the greatest ``time`` of their ``by`` group; ties all stay."""
    newest = df.groupBy(by).agg(F.max(time).alias(time))
    return lookup_join(df, newest, [by, time], "left_semi")


def latest_value(df: DataFrame, by: str, time: str, value: Column, name: str) -> DataFrame:
    """One value per ``by`` group, from its latest row; among ties the greatest."""
    newest = F.max(F.struct(F.col(time).alias("t"), value.alias("v")))
    return df.where(F.col(time).isNotNull()).groupBy(by).agg(newest["v"].alias(name))
