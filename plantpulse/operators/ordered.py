"""Row-to-row operators over ordered telemetry that stay parallel inside one key.

A plain window partitioned by machine puts all rows of that machine into one task, and one
chatty machine may hold a third of the data. The operators here cut time into slices, so the
window runs over (key, slice), and pass what crosses a slice border through a summary with one
row per key and slice. The results equal those of the plain window.

Slices are hours by default, which takes no look at the data. ``rows_per_slice`` cuts days instead: one in which some
key has more rows into minutes, and a minute that still has more into equal parts, at the price of two more reads of keys
and times. A slice depends on the time alone, so a frame is sliced once (``TimeOrder.sliced``) and every later
operator can use the slices, whatever its key.

Each operator reads its input once. The rows are exchanged by key and slice, and both the rows and the summary come
from that one exchange: the summary is taken from the first or last row of a slice after the window has put it in
order. Rows are packed into one column before the exchange, so that both sides ask for the same exchange; select the
columns that are needed before calling an operator. Where one operator feeds the next, put ``session.staged`` between
them once the rows have become few.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEY = "_key"
SLICE = "_slice"
_ROW = "_row"
_DAY = "_day"
_MINUTE = "_minute"
#: Slice of rows without a time, which come last.
_LAST = 2**63 - 1


@dataclass(frozen=True)
class TimeOrder:
    """Rows of each key, by time and then by a unique tie-breaker."""

    keys: Sequence[str]
    time: str = "time"
    tie: Sequence[str] = ("uuid",)
    slice_seconds: int = 3_600
    rows_per_slice: int | None = None

    def sort(self, descending: bool = False) -> list[Column]:
        cols = [F.col(c) for c in (self.time, *self.tie)]
        return [c.desc_nulls_first() if descending else c.asc_nulls_last() for c in cols]

    def rank(self) -> Column:
        """The order as one comparable value; a NULL tie-breaker ranks last."""
        parts = [F.col(self.time)]
        for c in self.tie:
            parts += [F.col(c).isNull().alias(f"{c}_missing"), F.col(c)]
        return F.struct(*parts)

    def position(self) -> Column:
        """Time and tie-breaker of a row."""
        return F.struct(*[F.col(c) for c in (self.time, *self.tie)])

    def key(self) -> Column:
        """The key as one value, so that rows with a NULL part stay together in joins too."""
        return F.struct(*[F.col(k) for k in self.keys]) if self.keys else F.lit(0)

    def within(self, descending: bool = False) -> WindowSpec:
        return W.partitionBy(KEY, SLICE).orderBy(*self.sort(descending))

    def across(self, descending: bool = False) -> WindowSpec:
        by = F.col(SLICE).desc() if descending else F.col(SLICE).asc()
        return W.partitionBy(KEY).orderBy(by)

    def sliced(self, df: DataFrame) -> DataFrame:
        """Add the slice column, unless the frame has one already.

        All slices have the fixed width, or with ``rows_per_slice`` a slice is a day, or a minute in a day that is too
        dense, or an equal part of a minute that is still too dense. All of them start at a time, and later rows never
        get an earlier slice. The dense cells are counted as a part of the plan, from key and time alone; no
        job runs while it is built.
        """
        if SLICE in df.columns:
            return df
        if self.rows_per_slice is None:
            return df.withColumn(SLICE, F.expr(self._start_of(self.slice_seconds)))
        # One row per day that is too dense.
        day = 86_400
        days = self._dense(df, _DAY, day).select(_DAY, F.lit(True).alias("_minutes"))
        in_dense_days = df.withColumn(_DAY, F.expr(self._start_of(day))).join(F.broadcast(days), _DAY)
        # A minute counts more than the limit, so there are at most rows / limit of them.
        parts = f"4 * ceil(_n / {self.rows_per_slice}) AS _parts"
        minutes = self._dense(in_dense_days, _MINUTE, 60).selectExpr(_MINUTE, parts)
        step = "greatest(1, 60000000 div _parts)"
        placed = (
            df.withColumns({_DAY: F.expr(self._start_of(day)), _MINUTE: F.expr(self._start_of(60))})
            .join(F.broadcast(days), _DAY, "left")
            .join(F.broadcast(minutes), _MINUTE, "left")
        )
        start = F.expr(
            f"CASE WHEN _parts IS NOT NULL THEN {self._micros()} - pmod({self._micros()} - {_MINUTE}, {step}) "
            f"WHEN _minutes THEN {_MINUTE} ELSE {_DAY} END")
        return placed.withColumn(SLICE, start).drop(_DAY, _MINUTE, "_minutes", "_parts")

    def _micros(self) -> str:
        return f"unix_micros(cast({self.time} as timestamp))"

    def _start_of(self, seconds: int) -> str:
        return f"{self._micros()} - pmod({self._micros()}, {seconds * 1_000_000})"

    def _counts(self, df: DataFrame, cell: str, seconds: int) -> DataFrame:
        cells = F.expr(self._start_of(seconds)).alias(cell)
        return df.groupBy(self.key().alias(KEY), cells).agg(F.expr("count(1) AS _n"))

    def _dense(self, df: DataFrame, cell: str, seconds: int) -> DataFrame:
        """Cells of time in which some key has more rows than a slice should hold."""
        counts = self._counts(df, cell, seconds)
        return counts.groupBy(cell).agg(F.expr("max(_n) AS _n")).where(f"_n > {self.rows_per_slice}")

    def dealt(self, df: DataFrame) -> DataFrame:
        """Key, slice and the columns of the frame, exchanged by key and slice.

        The rows travel as one column that can't be narrowed, so everything that starts from the result shares the exchange.
        """
        own = [c for c in df.columns if c != SLICE]
        # A slice that can't be NULL needs no filter, which would tell the joined sides apart.
        at = F.coalesce(F.col(SLICE), F.lit(_LAST)).alias(SLICE)
        packed = self.sliced(df).select(self.key().alias(KEY), at, F.array(F.struct(*own)).alias(_ROW))
        return packed.repartition(KEY, SLICE).select(KEY, SLICE, *[F.element_at(_ROW, 1)[c].alias(c) for c in own])


def _payload(columns: dict[str, str]) -> Column:
    return F.struct(*[F.col(source).alias(name) for name, source in columns.items()])


def _joined(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """Attach the summary to its rows.

    The window has left the rows distributed and sorted by key and slice, so a merge join only
    moves the summary. The summary may be large and is never broadcast.
    """
    return rows.join(summary.hint("merge"), [KEY, SLICE], "left")


def _ends(order: TimeOrder) -> Column:
    """Whether no other row of the slice follows."""
    return F.lead(F.lit(1)).over(order.within()).isNull()


def with_neighbours(
    df: DataFrame, order: TimeOrder, previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None, seen: str | None = None, more: str | None = None,
) -> DataFrame:
    """Values of the previous and of the next row of the key, as ``{new_name: column}``.

    ``seen`` names a flag that tells a missing previous row from one that holds NULL, ``more``
    the same for the next row.
    """
    base = order.dealt(df)
    so_far = order.within().rowsBetween(W.unboundedPreceding, 0)
    # Of a slice's last row: its own values and those of the slice's first row.
    sides = [("prev", previous, seen, F.lag, lambda v: v), ("next", following, more, F.lead, lambda v: F.first(v).over(so_far))]
    near, edges, across, extra = {}, [], [], []
    for side, columns, flag, step, edge in sides:
        if not columns:
            continue
        payload = _payload(columns)
        near[f"_near_{side}"] = step(payload).over(order.within())
        edges.append(edge(payload).alias(f"_edge_{side}"))
        across.append(step(f"_edge_{side}").over(order.across()).alias(f"_far_{side}"))
        hit = F.coalesce(f"_near_{side}", f"_far_{side}")
        extra += [hit[name].alias(name) for name in columns]
        extra += [hit.isNotNull().alias(flag)] if flag else []
    border = base.select(KEY, SLICE, *edges, _ends(order).alias("_ends")).where("_ends").select(KEY, SLICE, *across)
    return _joined(base.withColumns(near), border).select(*df.columns, *extra)


def with_previous(df: DataFrame, order: TimeOrder, seen: str | None = None, **columns: str) -> DataFrame:
    """Values of the previous row of the key, as ``new_name=column``."""
    return with_neighbours(df, order, previous=columns, seen=seen)


def with_next(df: DataFrame, order: TimeOrder, more: str | None = None, **columns: str) -> DataFrame:
    """Values of the next row of the key, as ``new_name=column``."""
    return with_neighbours(df, order, following=columns, more=more)


def with_next_rows(
    df: DataFrame, order: TimeOrder, n: int, alias: str, columns: Sequence[str], same_instant: bool = False
) -> DataFrame:
    """Array of the next ``n`` rows of the key (fewer at the end), nearest first.

    With ``same_instant`` every other row of the row's own instant counts as next, so those that the
    tie-breaker puts before it come first.
    """
    base = order.dealt(df)
    row = F.struct(*columns)
    heads = (
        base.select(KEY, SLICE, row.alias("row"), F.row_number().over(order.within()).alias("_rn"))
        .where(F.col("_rn") <= n)
        .groupBy(KEY, SLICE)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_rn", "row"))), lambda x: x["row"]).alias("_heads"))
    )
    found = F.array(*[F.lead("_heads", i).over(order.across()) for i in range(1, n + 1)])
    later = heads.select(KEY, SLICE, F.flatten(F.filter(found, lambda a: a.isNotNull())).alias("_later"))
    near = F.array(*[F.lead(row, i).over(order.within()) for i in range(1, n + 1)])
    if same_instant:
        # Rows of one instant are in one slice.
        earlier = W.partitionBy(KEY, SLICE, order.time).orderBy(*order.sort()).rowsBetween(W.unboundedPreceding, -1)
        near = F.concat(F.array(*[F.nth_value(row, i).over(earlier) for i in range(1, n + 1)]), near)
    joined = _joined(base.withColumn("_near", F.filter(near, lambda r: r.isNotNull())), later)
    return joined.select(*df.columns, F.slice(F.concat("_near", "_later"), 1, n).alias(alias))


def carry_both(df: DataFrame, order: TimeOrder, forward: dict[str, str], backward: dict[str, str]) -> DataFrame:
    """Last non-NULL value up to each row for ``forward``, first one from it on for ``backward``, as ``{new_name: column}``.

    Both directions come from one order, so the rows are read and exchanged once.
    """
    base = order.dealt(df)
    so_far = order.within().rowsBetween(W.unboundedPreceding, 0)
    to_come = order.within(True).rowsBetween(W.unboundedPreceding, 0)
    near = {f"_near_{n}": F.last(c, True).over(so_far) for n, c in forward.items()}
    near_back = {f"_near_{n}": F.last(c, True).over(to_come) for n, c in backward.items()}
    # What a slice's last row has met is the slice's last and first value.
    edges = base.select(
        KEY, SLICE, *[v.alias(k) for k, v in near.items()], *[F.first(c, True).over(so_far).alias(f"_near_{n}") for n, c in backward.items()],
        _ends(order).alias("_ends")).where("_ends")
    before, after = (order.across(b).rowsBetween(W.unboundedPreceding, -1) for b in (False, True))
    far = edges.select(
        KEY, SLICE, *[F.last(f"_near_{n}", True).over(before).alias(f"_far_{n}") for n in forward],
        *[F.last(f"_near_{n}", True).over(after).alias(f"_far_{n}") for n in backward])
    joined = _joined(base.withColumns(near | near_back), far)
    new = [*forward, *backward]
    return joined.select(*[c for c in df.columns if c not in new], *[F.coalesce(f"_near_{n}", f"_far_{n}").alias(n) for n in new])


def carry(df: DataFrame, order: TimeOrder, backward: bool = False, **columns: str) -> DataFrame:
    """Last non-NULL value up to and including each row (or the next one, ``backward``)."""
    return carry_both(df, order, {}, columns) if backward else carry_both(df, order, columns, {})


def islands(df: DataFrame, order: TimeOrder, value: Sequence[str], alias: str = "island") -> DataFrame:
    """Tag each row with the start row of its run of equal values.

    The tag is the (time, tie-breaker) of the run's first row. NULL equals NULL.
    """
    base = order.dealt(df)
    now = F.struct(*value)
    first = F.lag(F.lit(1)).over(order.within()).isNull()
    # Inside a slice a run starts where the value changes; whether it does at the slice's first row is told across slices.
    started = base.withColumns({"_now": now, "_was": F.lag(now).over(order.within()), "_first": first}).withColumn(
        "_start", F.when(~F.col("_first") & ~F.col("_was").eqNullSafe(F.col("_now")), order.position()))
    so_far = order.within().rowsBetween(W.unboundedPreceding, 0)
    tagged = started.withColumn("_near", F.last("_start", True).over(so_far))
    ends = tagged.select(
        KEY, SLICE, F.col("_now").alias("_last_value"), F.col("_near").alias("_last_start"), F.first("_now").over(so_far).alias("_first_value"),
        F.first(order.position()).over(so_far).alias("_first_at"), _ends(order).alias("_ends")).where("_ends")
    met = ends.withColumn("_before", F.lag("_last_value").over(order.across()))
    opened = met.withColumn("_opens", F.when(~F.coalesce(F.col("_before").eqNullSafe(F.col("_first_value")) & F.col("_before").isNotNull(), F.lit(False)), F.col("_first_at")))
    upto = order.across().rowsBetween(W.unboundedPreceding, -1)
    running = F.last(F.coalesce("_last_start", "_opens"), True).over(upto)
    far = opened.select(KEY, SLICE, F.coalesce("_opens", running).alias("_far"))
    return _joined(tagged, far).select(*df.columns, F.coalesce("_near", "_far").alias(alias))
