"""Telemetry tables derived from the standard test tables.

Each stand-in is one select list, kept as text that both engines understand, so that the
query and its SQL twin start from the same rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# The integer in events.props, per engine.
_K = {"spark": "cast(get_json_object(props, '$.k') as int)",
      "duckdb": "cast(json_extract_string(props, '$.k') as int)"}
_TIME = {"spark": "timestamp_ntz", "duckdb": "timestamp"}
_BATCH = "cast(cast(floor((day(ts) - 1) / 10) as int) as string)"
_MACHINE = "cast(user_id as string)"

_EVENT_VIEWS: dict[str, dict[str, str]] = {
    "alarms": {
        # Whole hours, so that rows share their time; two alarms per serial and three serials per machine type.
        "uuid": "event_id",
        "time": "cast(date_trunc('hour', ts) as {time})",
        "line": "concat('L', cast(user_id % 4 as string))",
        "machine": "concat('M', cast(cast(floor(user_id / 3) as int) as string))",
        "serial": _MACHINE,
        "idx": "cast(event_id % 2 + 1 as string)",
        "state": "cast(case event_type when 'error' then 10 when 'purchase' then 20 else 0 end as double)",
        "recipe": "concat('J', cast(cast(floor({k} / 25) as int) as string))",
        "batch": _BATCH,
        "skey": "concat('_29_', cast(user_id % 3 + 1 as string), '_39_', cast(event_id % 4 + 1 as string))",
    },
    "general": {
        "uuid": "event_id",
        "time": "ts",
        "line": "concat('L', cast(user_id % 4 as string))",
        "machine": _MACHINE,
        "serial": _MACHINE,
        "recipe": "event_type",
        "batch": _BATCH,
        "day_batch": "cast(day(ts) as string)",
        "program_state": "cast(case event_type when 'click' then 100 when 'view' then 300 "
                         "when 'purchase' then 500 when 'error' then 600 end as double)",
        "mode_state": "cast(case when {k} % 3 = 0 then {k} % 4 end as double)",
        "total_cases": "event_id",
        "box_made": "case when {k} % 2 = 0 then 1 else 0 end",
    },
    "weights": {
        "uuid": "event_id",
        "time": "ts",
        "line": "concat('L', cast(user_id % 4 as string))",
        "machine": _MACHINE,
        "serial": _MACHINE,
        "logger": "concat('G', cast(user_id % 2 as string))",
        "unit_id": "concat('W', cast(user_id % 2 + 1 as string))",
        "recipe": "concat('J', cast(cast(floor({k} / 25) as int) as string))",
        "batch": _BATCH,
        "net": "value",
        "setpoint": "cast(case when {k} % 10 = 0 then 30 else 20 end as double)",
        "max_over": "cast(5 as double)",
        "max_under": "cast(5 as double)",
        "tare": "cast({k} as double) / 100",
        "unit_code": "cast(user_id % 4 as int)",
        "result_code": "case when {k} % 10 = 0 then 20 else 10 end",
        "module_index": "{k} % 4",
        "module_key": "concat('M', cast({k} % 4 as string))",
        "struct_version": "1",
        "custom_1": "concat('C', cast({k} % 3 as string))",
        "custom_2": "concat('D', cast({k} % 2 as string))",
    },
    "status": {
        "uuid": "event_id",
        "time": "ts",
        # Several machines of one type name, told apart by their index.
        "machine": "concat('T', cast(user_id % 10 as string))",
        "machine_index": "cast(cast(floor(user_id / 10) as int) as string)",
        "batch": _BATCH,
        "in_production": "cast({k} % 2 as double)",
        "default_state": "cast(case when {k} % 5 = 0 then 1 else 0 end as double)",
        "ready": "cast(case when {k} % 3 = 0 then 1 else 0 end as double)",
    },
    "access_log": {
        "uuid": "event_id",
        "logtime": "ts",
        "category": "case when {k} % 2 = 0 then 'Dashboard' else 'function' end",
        "organization": "case when event_type <> 'signup' then event_type end",
        "dashboard": "concat('D', cast({k} % 5 as string))",
        "username": _MACHINE,
    },
}

# Lookup of translated alarm texts: type, general key, language, text.
_TRANSLATIONS = [
    (6, "_29_1_39_1", "en_US", "Emergency stop"),
    (6, "_29_1_39_1", "nl_BE", "Noodstop"),
    (6, "_29_1_39_1", "pl_PL", "Wylacznik awaryjny"),
    (6, "_29_1_39_2", "en_US", "Door open"),
    (6, "_29_1_39_2", "nl_BE", "Deur open"),
    (6, "_29_1_39_2", "pl_PL", "Otwarte drzwi"),
    (6, "_29_1_39_3", "en_US", "Motor fault"),
    (6, "_29_1_39_3", "nl_BE", "Motorfout"),
    (6, "_29_1_39_3", "pl_PL", "Awaria silnika"),
    (6, "_29_1_39_4", "en_US", "Low pressure"),
    (6, "_29_1_39_4", "nl_BE", "Lage druk"),
]


def _values() -> str:
    rows = ", ".join(f"({t}, '{k}', '{g}', '{x}')" for t, k, g, x in _TRANSLATIONS)
    return (
        "SELECT v.type_id, v.skey, v.language, v.translation, "
        "concat(v.language, '_', cast(v.type_id as string), v.skey) AS unique_key "
        f"FROM (VALUES {rows}) AS v(type_id, skey, language, translation)"
    )


def _columns(view: str, engine: str) -> list[str]:
    return [f"{e.replace('{k}', _K[engine]).replace('{time}', _TIME[engine])} AS {name}" for name, e in _EVENT_VIEWS[view].items()]


def sql_views(body: str) -> str:
    """Put the stand-in views a statement reads in front of it."""
    used = [v for v in _EVENT_VIEWS if re.search(rf"\b{v}\b", body)]
    views = [f"{v} AS (SELECT {', '.join(_columns(v, 'duckdb'))} FROM events)" for v in used]
    if re.search(r"\btranslations\b", body):
        views.append(f"translations AS ({_values()})")
    text = body.strip()
    if not views:
        return text
    if text[:4].upper() == "WITH":
        return f"WITH {', '.join(views)}, {text[4:].strip()}"
    return f"WITH {', '.join(views)} {text}"


@dataclass(frozen=True)
class Plant:
    """The tables of one folder: the standard ones and the telemetry stand-ins."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str, events: DataFrame | None = None) -> DataFrame:
        source = self.table("events") if events is None else events
        return source.selectExpr(*_columns(name, "spark"))

    @property
    def alarms(self) -> DataFrame:
        return self.view("alarms")

    @property
    def general(self) -> DataFrame:
        return self.view("general")

    @property
    def weights(self) -> DataFrame:
        return self.view("weights")

    @property
    def status(self) -> DataFrame:
        return self.view("status")

    @property
    def access_log(self) -> DataFrame:
        return self.view("access_log")

    @property
    def translations(self) -> DataFrame:
        return self.spark.sql(_values())
