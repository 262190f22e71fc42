"""JSON text, list-of-pairs text and comma-broken CSV as Column expressions."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_number(c, name: str) -> Column:
    """One JSON member as a double, quoted or not; null when it is no number."""
    return F.get_json_object(_col(c), f"$.{name}").try_cast("double")


def json_columns(df: DataFrame, payload: str, members: dict[str, str], keep_payload: bool = False) -> DataFrame:
    """Add a double column per ``{column: member}`` of a JSON object, quoted or
    not; null when absent or no number.

    A generator parses each text once, however many filters use the columns."""
    raw = {column: f"_json_{column}" for column in members}
    kept = [c for c in df.columns if c not in members]
    parsed = df.select(*kept, F.json_tuple(payload, *members.values()).alias(*raw.values()))
    out = [F.col(r).try_cast("double").alias(column) for column, r in raw.items()]
    return parsed.select(*[c for c in kept if keep_payload or c != payload], *out)


def json_doubles(c, names: list[str]) -> Column:
    """Several members as typed doubles in one parse. A quoted number is null."""
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    return F.from_json(_col(c), schema)


def json_sum(c, names: list[str]) -> Column:
    """Sum of members, a missing one counting as zero."""
    parsed = F.from_json(_col(c), T.StructType([T.StructField(n, T.StringType()) for n in names]))
    total = F.lit(0.0)
    for name in names:
        total = total + F.coalesce(parsed[name].try_cast("double"), F.lit(0.0))
    return total


def json_map(c) -> Column:
    return F.from_json(_col(c), T.MapType(T.StringType(), T.StringType()))


def _object_merge(patching: bool):
    """Merging of two JSON objects, as a function on Arrow batches: Spark's maps refuse
    a repeated member, and no expression goes down to members of any depth."""

    def number(text: str):
        value = float(text)
        return int(value) if value.is_integer() and abs(value) < 1e15 else value

    def parsed(text) -> dict:
        try:
            value = json.loads(text, parse_float=number) if text else {}
        except ValueError:
            value = {}
        return value if isinstance(value, dict) else {}

    def merged(base: dict, patch: dict) -> dict:
        kept = {k: v for k, v in base.items() if k not in patch}
        for name, value in patch.items():
            if patching and isinstance(value, dict):
                below = base.get(name)
                kept[name] = merged(below if isinstance(below, dict) else {}, value)
            elif not patching or value is not None:
                kept[name] = value
        return kept

    def work(base: pd.Series, patch: pd.Series) -> pd.Series:
        made = [merged(parsed(a), parsed(b)) for a, b in zip(base, patch, strict=True)]
        return pd.Series([json.dumps(m, ensure_ascii=False, separators=(",", ":")) for m in made], dtype=object)

    work.__annotations__ = {"base": pd.Series, "patch": pd.Series, "return": pd.Series}
    return F.pandas_udf(work, "string")


def json_merge(base, patch) -> Column:
    """One object holding the members of both; the patch wins on a shared name.

    Values are kept as JSON values (numbers stay numbers). Of a member that an object
    has twice the last one counts; text that is no object counts as an empty one."""
    return _object_merge(False)(_col(base), _col(patch))


def json_merge_patch(base, patch) -> Column:
    """JSON merge patch: like :func:`json_merge`, but objects are merged at any depth
    and a member that is null in the patch is removed."""
    return _object_merge(True)(_col(base), _col(patch))


def all_fields_json(columns: list[str]) -> Column:
    """The whole record as JSON text, null fields left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "true"})


def pair_texts(c) -> Column:
    """``[[a, b],[c, d]]`` as ``array<array<string>>``; null text gives null."""
    groups = F.split(F.replace(_col(c), F.lit(" "), F.lit("")), r"\],\[")
    return F.transform(groups, lambda g: F.split(F.regexp_replace(g, r"[\[\]]", ""), ","))


def pair_item(pair: Column, position: int) -> Column:
    """Member of one inner list as a double; null when absent or no number."""
    return F.get(pair, position).try_cast("double")


# Leading scalar fields of the broken CSV lines.
CSV_SCALARS = ["id", "station_id", "station_code", "grid_id"]


def restitch_csv(line) -> list[Column]:
    """Columns of a CSV line whose two JSON fields hold unquoted commas.

    Fields 0-3 are scalars, 4-5 the coordinate, 6 to last-but-one the data, and
    the last one the time. A line with fewer than 8 fields gives nulls.
    """
    parts = F.split(_col(line), ",", -1)
    n = F.size(parts)
    whole = n >= 8
    scalars = [F.when(whole, F.get(parts, i)).alias(name) for i, name in enumerate(CSV_SCALARS)]
    coord = F.when(whole, F.array_join(F.slice(parts, 5, 2), ","))
    data = F.when(whole, F.array_join(F.slice(parts, F.lit(7), F.greatest(n - 7, F.lit(0))), ","))
    time = F.when(whole, F.get(parts, n - 1))
    return [*scalars, coord.alias("coord"), data.alias("data"), time.alias("published_at")]
