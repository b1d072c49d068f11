"""Metrics named by text."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse.plans import metrics as plan
from plantpulse.plans.machines import recipe_periods
from plantpulse.queries.joins import PERIODS_SQL
from plantpulse.queries.registry import query
from plantpulse.queries.weights import rounded

_RANGE = "time BETWEEN TIMESTAMP '2024-01-04' AND TIMESTAMP '2024-01-25'"
SPECS = [plan.parse(t) for t in (
    "weights|net|sum", "weights|net|avg|result_code = 20", "weights|tare|max", "weights|setpoint|min|net > 10")]
_VALUES = ["sum(net)", "avg(net) FILTER (result_code = 20)", "max(tare)", "min(setpoint) FILTER (net > 10)"]
_LABELS = ["sum_net", "avg_net", "max_tare", "min_setpoint"]


def _range():
    return [F.lit(x).cast("timestamp_ntz") for x in ("2024-01-04", "2024-01-25")]


@query("metric_one", f"SELECT round(avg(net) FILTER (result_code = 20), 6) AS value FROM weights WHERE {_RANGE}")
def _(p):
    return rounded(plan.metric_one(p.weights, SPECS[1], *_range()))


@query("metric_list", " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{label}' AS label, round({value}, 6) AS value FROM weights WHERE {_RANGE}"
    for i, (label, value) in enumerate(zip(_LABELS, _VALUES))))
def _(p):
    return rounded(plan.metric_list(p.weights, SPECS, *_range()))


_INSIDE = f"""
WITH {PERIODS_SQL},
x AS (SELECT d.*, w.* EXCLUDE (serial) FROM d JOIN weights w ON w.serial = d.serial AND w.time BETWEEN d.time_from AND d.time_to)
"""


@query("metric_per_period", f"""{_INSIDE}
SELECT serial, period_recipe, time_from, time_to, unnest({_LABELS!r}) AS name,
  unnest([{', '.join(f'round({v}, 6)' for v in _VALUES)}]) AS value
FROM x GROUP BY serial, period_recipe, time_from, time_to""")
def _(p):
    arrays = plan.metric_per_period(p.weights, recipe_periods(p.general), SPECS)
    return rounded(plan.unnest_arrays(arrays, plan.PERIOD_KEYS))


@query("metric_per_period_wide", f"""{_INSIDE}
SELECT serial, period_recipe, time_from, time_to, {', '.join(f'round({v}, 6) AS d{i + 1}' for i, v in enumerate(_VALUES))},
  0.0::DOUBLE AS d5, 0.0::DOUBLE AS d6, 0.0::DOUBLE AS d7
FROM x GROUP BY serial, period_recipe, time_from, time_to""")
def _(p):
    return rounded(plan.metric_per_period_wide(p.weights, recipe_periods(p.general), SPECS, columns=7))
