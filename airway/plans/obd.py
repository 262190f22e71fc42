"""On-board diagnostics: active devices and flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from airway.functions.records import json_columns, json_doubles
from airway.operators.cleaning import all_nonzero
from airway.operators.merging import rows_of_frequent_keys

# Diagnostic codes and the row threshold of an active device.
ACTIVITY_CODES = ["6413", "6415", "6411"]
FLAT_CODES = {"lon": "6423", "lat": "6422", "oil": "6420"}
ACTIVE_ROWS = 10000
KEPT = ["device_id", "dynamic_data", "error_data", "published_at"]


def running(payload: str = "dynamic_data") -> Column:
    """All activity codes are JSON numbers other than zero."""
    return all_nonzero(json_doubles(payload, ACTIVITY_CODES), ACTIVITY_CODES)


def running_rows(obd: DataFrame) -> DataFrame:
    return obd.select(*KEPT).where(running()).na.drop()


def active_filter_first(obd: DataFrame, more_than: int = ACTIVE_ROWS) -> DataFrame:
    """Running rows of devices with enough *running* rows."""
    return rows_of_frequent_keys(running_rows(obd), "device_id", more_than)


def active_count_first(obd: DataFrame, more_than: int = ACTIVE_ROWS) -> DataFrame:
    """Running rows of devices with enough rows of any kind."""
    return rows_of_frequent_keys(running_rows(obd), "device_id", more_than, counted=obd)


def flatten(obd: DataFrame) -> DataFrame:
    """Position and oil level as doubles; a row with any null column is dropped."""
    parsed = json_columns(obd, "dynamic_data", FLAT_CODES, keep_payload=True)
    return parsed.na.drop().select("device_id", *FLAT_CODES, "published_at")


def metric_projection(obd: DataFrame) -> DataFrame:
    return obd.select("device_id", "scr_6413", "enter_air_6415", "ef_6411", "published_at")
