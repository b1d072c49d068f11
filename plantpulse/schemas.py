"""Columns of the telemetry tables, and their names in the machines' raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

_TYPES = {
    "text": StringType(), "time": TimestampNTZType(), "number": DoubleType(), "int": IntegerType(),
    "long": LongType(), "flag": BooleanType(),
}


def _schema(**columns: str) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in columns.items()])


_MACHINE = {"time": "time", "line": "text", "machine": "text", "serial": "text", "recipe": "text", "batch": "text"}

ALARMS = _schema(**_MACHINE, uuid="text", idx="text", skey="text", state="number", mark="text")
ALARMS_CONSOLIDATED = _schema(**_MACHINE, uuid="text", idx="text", skey="text", state="number", edge="flag")
ALARM_LINES = _schema(
    time="time", machine="text", serial="text", recipe="text", batch="text", idx="text", skey="text",
    max_state="number", active_end="time", waiting_end="time", alarm_end="time", active_seconds="number",
    waiting_seconds="number", alarm_seconds="number", block_uuid="text")
GENERAL = _schema(
    **_MACHINE, uuid="text", mode_state="number", program_state="number", carried_mode_state="number",
    carried_program_state="number", total_cases="number", box_made="number")
BOX_PRODUCTION = _schema(
    **_MACHINE, batch_start="time", batch_end="time", duration_hours="number", boxes="number",
    boxes_per_hour="number", first_uuid="text", last_uuid="text")
WEIGHTS = _schema(
    **_MACHINE, uuid="text", logger="text", unit_id="text", net="number", tare="number", setpoint="number",
    max_over="number", max_under="number", unit_code="int", result_code="int", module_index="int",
    struct_version="int", module_key="text", custom_1="text", custom_2="text")
STATUS = _schema(time="time", uuid="text", machine="text", machine_index="text", batch="text", in_production="number",
                 default_state="number", ready="number")
ACCESS_LOG = _schema(uuid="text", logtime="time", category="text", organization="text", dashboard="text",
                     username="text")
TRANSLATIONS = _schema(type_id="int", skey="text", language="text", translation="text", unique_key="text")

# Column names of the raw tables, as the machines write them.
RAW_NAMES = {
    "machineserial": "serial",
    "recipeloadcounter": "batch",
    "alarmstate": "state",
    "skey_1": "mark",
    "loggeractivationuid": "logger",
    "boxmade": "box_made",
    "stinfo_ntotalcases": "total_cases",
    "stmachine_emodestate": "mode_state",
    "stmachine_emachineprogramstate": "program_state",
    "carry_fw_modestate": "carried_mode_state",
    "carry_fw_programstate": "carried_program_state",
    "recipientweight_fnetweight": "net",
    "recipientweight_ftareweight": "tare",
    "recipientweight_fsetpoint": "setpoint",
    "recipientweight_fmaxoverweight": "max_over",
    "recipientweight_fmaxunderweight": "max_under",
    "recipientweight_eunit": "unit_code",
    "recipientweight_eweightresult": "result_code",
    "recipientweight_imoduleindex": "module_index",
    "recipientweight_istructversion": "struct_version",
    "recipientweight_smodulekey": "module_key",
    "recipientweight_sunitid": "unit_id",
    "recipientweight_scustomfield1": "custom_1",
    "recipientweight_scustomfield2": "custom_2",
    "machine_in_production": "in_production",
    "machine_default": "default_state",
    "machine_ready": "ready",
    "logcategory": "category",
    "graf_organization": "organization",
    "graf_dashboard": "dashboard",
    "graf_username": "username",
    "uniquekey": "unique_key",
    "typeid": "type_id",
}


def from_raw(df: DataFrame) -> DataFrame:
    """Rename the columns of a raw table; names this library does not know stay."""
    return df.withColumnsRenamed({c: RAW_NAMES[c.lower()] for c in df.columns if c.lower() in RAW_NAMES})
