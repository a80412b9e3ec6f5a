"""The period summary: Day, Week and Month rows under the current and the historical rules.

Before the cutoff the Day grain counts event days; Week and Month are cohorts in both regimes. The cutoff must
be the first day of a month; the Week grain switches at the Monday of the cutoff's week.

All grains come out of one aggregation. Every cell *contributes* to the days its backlog lasts, to its own week and
month, and - where its last backlog day crosses the boundary - to the next week or month. ``acc_total`` of a week or
month is the distinct union of the daily backlogs over the period's opening days: a task opened in the period is
always in it, and one opened ``j`` days before the period is in it if the first opening day is at most
``BACKLOG_DAYS - 1 - j`` days into the period. So six plain sums, one per ``j``, replace a distinct count of tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill import DIMENSIONS
from cohortmill.functions.dates import (
    GRAINS, DateLike, as_date, check_grain, iso_year, month_key, month_name, period_key, period_name, period_start,
    week_key, week_name,
)
from cohortmill.operators.cohort import BACKLOG_DAYS, CELL_KEYS, SUFFIX, acc_rolling, cohort_cells, counted
from cohortmill.operators.filters import TASK_DATES

QUANTITIES = ("total_qty", "todo_qty", "doing_qty", "done_qty", "doing_done_qty", "acc_qty", "acc_total_qty")
SUMMARY_COLUMNS = (
    "period_type", "period_key", "snapshot_date", "sort_order", "period_name", *DIMENSIONS, *QUANTITIES,
)
_COUNTS = ("total", "todo", "doing", "done", "acc", "acc_total")


def check_cutoff(cutoff: dt.date | str) -> dt.date:
    day = dt.date.fromisoformat(cutoff) if isinstance(cutoff, str) else cutoff
    if day.day != 1:
        raise ValueError(f"cutoff must be the first day of a month, got {day}")
    return day


def _next_period(grain: str, start: Column) -> Column:
    return F.date_add(start, 7) if grain == "Week" else F.add_months(start, 1)


def _contribution(grain: str, start: Column, own_day: Column | None = None, carry_days: Column | int = 0,
                  carry: Column | None = None, **counts: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.struct(
        F.lit(grain).alias("period_type"),
        start.alias("period_start"),
        (F.lit(None).cast("date") if own_day is None else own_day).alias("own_day"),
        *[counts.get(name, zero).cast("bigint").alias(name) for name in _COUNTS],
        (carry_days if isinstance(carry_days, Column) else F.lit(carry_days)).cast("int").alias("carry_days"),
        (zero if carry is None else carry).alias("carry"),
    )


def _day_contributions(cutoff: Column | None) -> list[Column]:
    day, total = F.col("snapshot_date"), F.col("total_task")
    own = {name: F.col(f"{name}_daily") for name in ("todo", "doing", "done")} | {"total": total}
    own_day = day
    if cutoff is not None:  # before the cutoff the counters are event days, not openings
        current = day >= cutoff
        own = {name: F.when(current, value).otherwise(F.lit(0)) for name, value in own.items()}
        own_day = F.when(current, day)
    contributions = [_contribution("Day", day, own_day, acc=F.col("open_0"), acc_total=total, **own)]
    for k in range(1, BACKLOG_DAYS):
        contributions.append(_contribution("Day", F.date_add(day, k), acc=F.col(f"open_{k}"), acc_total=total))
    return contributions


def _cohort_contributions(grain: str, cutoff: Column | None) -> list[Column]:
    day, total, suffix = F.col("snapshot_date"), F.col("total_task"), SUFFIX[grain]
    todo, doing, done = (F.col(f"{name}_{suffix}") for name in ("todo", "doing", "done"))
    start = period_start(grain, day)
    following = _next_period(grain, start)
    own = _contribution(grain, start, day, total=total, todo=todo, doing=doing, done=done,
                        acc=todo + doing, acc_total=total)
    carries = F.date_add(day, BACKLOG_DAYS - 1) >= following
    if cutoff is not None:
        first_current = period_start(grain, cutoff)
        carries = carries & (following >= first_current)
        if grain == "Week":  # historical weeks leave out days of another ISO year
            own = F.when((start >= first_current) | (iso_year(day) == F.year(day)), own)
    return [own, F.when(carries, _contribution(
        grain, following, carry_days=F.date_diff(following, day), carry=total
    ))]


def _contributions(cells: DataFrame, grains: Sequence[str], cutoff: Column | None = None) -> DataFrame:
    parts = []
    for grain in grains:
        parts += _day_contributions(cutoff) if check_grain(grain) == "Day" else _cohort_contributions(grain, cutoff)
    # a NULL entry becomes a row of NULLs; dropping it afterwards keeps the generator in compiled code
    return cells.select(*DIMENSIONS, F.inline(F.array(*parts))).where(F.col("period_type").isNotNull())


def _by_grain(**values: Column) -> Column:
    kind = F.col("period_type")
    return F.when(kind == "Day", values["Day"]).when(kind == "Week", values["Week"]).otherwise(values["Month"])


def _periods(contributions: DataFrame, keep: Column) -> DataFrame:
    """Add up contributions per period and levels, and label the periods."""
    carried = [
        F.sum(F.when(F.col("carry_days") == j, F.col("carry")).otherwise(F.lit(0))).alias(f"carry_{j}")
        for j in range(1, BACKLOG_DAYS)
    ]
    sums = contributions.groupBy("period_type", "period_start", *DIMENSIONS).agg(
        *[F.sum(name).alias(name) for name in _COUNTS],
        F.min("own_day").alias("first_day"), F.max("own_day").alias("last_day"), *carried,
    ).where(keep)
    days_in = F.date_diff("first_day", "period_start")
    reached = F.lit(0).cast("bigint")
    for j in range(1, BACKLOG_DAYS):
        reached = reached + F.when(days_in <= BACKLOG_DAYS - 1 - j, F.col(f"carry_{j}")).otherwise(F.lit(0))
    start = F.col("period_start")
    return sums.select(
        "period_type",
        _by_grain(Day=start.cast("string"), Week=week_key(start), Month=month_key(start)).alias("period_key"),
        F.when(F.col("period_type") == "Day", start).otherwise(F.col("last_day")).alias("snapshot_date"),
        F.lit(0).alias("sort_order"),
        _by_grain(Day=start.cast("string"), Week=week_name(start), Month=month_name(start)).alias("period_name"),
        *DIMENSIONS,
        F.col("total").alias("total_qty"), F.col("todo").alias("todo_qty"), F.col("doing").alias("doing_qty"),
        F.col("done").alias("done_qty"), (F.col("doing") + F.col("done")).alias("doing_done_qty"),
        F.col("acc").alias("acc_qty"), (F.col("acc_total") + reached).alias("acc_total_qty"),
    )


def current_summary(cells: DataFrame, grains: Sequence[str] = GRAINS, since: DateLike | None = None) -> DataFrame:
    """Current rows of the given grains from the period holding ``since`` on.

    Days on which nothing was opened appear with their backlog; weeks and months need an opening.
    """
    keep = (F.col("period_type") == "Day") | F.col("first_day").isNotNull()
    if since is not None:
        first = as_date(since)
        keep = keep & (F.col("period_start") >= _by_grain(**{g: period_start(g, first) for g in GRAINS}))
    return _periods(_contributions(cells, grains), keep)


def day_summary(cells: DataFrame, since: DateLike | None = None) -> DataFrame:
    return current_summary(cells, ["Day"], since)


def week_summary(cells: DataFrame, since: DateLike | None = None) -> DataFrame:
    return current_summary(cells, ["Week"], since)


def month_summary(cells: DataFrame, since: DateLike | None = None) -> DataFrame:
    return current_summary(cells, ["Month"], since)


def event_days(fact: DataFrame, before: DateLike | None = None) -> DataFrame:
    """Each counted task once per distinct opening, claim and end date, of the days ``before`` a date if given.

    The bound is also put on the dates themselves, where it reaches the file scan.
    """
    tasks = counted(fact)
    if before is not None:
        early = [F.col(c) < as_date(before) for c in TASK_DATES]
        tasks = tasks.where(early[0] | early[1] | early[2])
    days = tasks.select(
        *DIMENSIONS, "task_claim_date", "task_end_date",
        F.explode(F.array_distinct(F.array(*TASK_DATES))).alias("snapshot_date"),
    )
    day = F.col("snapshot_date")
    return days.where(day.isNotNull() if before is None else day < as_date(before))


def _event_states(as_of: DateLike) -> dict[str, Column]:
    """State of a task on an event day; a task claimed after its end may be both todo and done."""
    day, claim, end = F.col("snapshot_date"), F.col("task_claim_date"), F.col("task_end_date")
    return {
        "todo": day < F.coalesce(claim, end, F.date_add(as_date(as_of), 1)),
        "doing": claim.isNotNull() & (day >= claim) & (end.isNull() | (day < end)),
        "done": end.isNotNull() & (day >= end),
    }


def historical_day_counts(fact: DataFrame, as_of: DateLike, before: DateLike | None = None) -> DataFrame:
    """Event-day counters per date and levels."""
    return event_days(fact, before).groupBy(*CELL_KEYS).agg(
        F.count(F.lit(1)).alias("total_qty"),
        *[F.count_if(state).alias(f"{name}_qty") for name, state in _event_states(as_of).items()],
    )


def historical_day_summary(fact: DataFrame, cells: DataFrame, as_of: DateLike,
                           before: DateLike | None = None) -> DataFrame:
    """Historical Day rows with the rolling backlog of the same date and levels (0 when there is none)."""
    backlog = acc_rolling(cells).select(
        *CELL_KEYS, F.col("acc").alias("acc_qty"), F.col("acc_total_task").alias("acc_total_qty")
    )
    joined = (
        historical_day_counts(fact, as_of, before).join(backlog, [*CELL_KEYS], "left")
        .fillna(0, ["acc_qty", "acc_total_qty"])
    )
    return _labelled(joined, "Day", F.col("snapshot_date"))


def historical_cohort_summary(cells: DataFrame, grain: str, before: DateLike | None = None,
                              drop_cross_year: bool | None = None) -> DataFrame:
    """Historical Week or Month rows; acc_total is the cohort total.

    Weeks drop the days whose ISO year differs from the calendar year unless told otherwise.
    """
    drop = grain == "Week" if drop_cross_year is None else drop_cross_year
    if before is not None:
        cells = cells.where(F.col("snapshot_date") < period_start(grain, as_date(before)))
    if drop:
        cells = cells.where(iso_year("snapshot_date") == F.year("snapshot_date"))
    suffix = SUFFIX[grain]
    grouped = cells.groupBy(period_start(grain, "snapshot_date").alias("period_start"), *DIMENSIONS).agg(
        F.max("snapshot_date").alias("snapshot_date"), F.sum("total_task").alias("total_qty"),
        *[F.sum(f"{name}_{suffix}").alias(f"{name}_qty") for name in ("todo", "doing", "done")],
    )
    return _labelled(grouped.withColumns({
        "acc_qty": F.col("todo_qty") + F.col("doing_qty"), "acc_total_qty": F.col("total_qty"),
    }), grain, F.col("period_start"))


def _labelled(df: DataFrame, grain: str, start: Column) -> DataFrame:
    return df.withColumns({
        "period_type": F.lit(grain), "period_key": period_key(grain, start), "sort_order": F.lit(0),
        "period_name": period_name(grain, start), "doing_done_qty": F.col("doing_qty") + F.col("done_qty"),
    }).select(*SUMMARY_COLUMNS)


def task_summary(fact: DataFrame, cutoff: dt.date | str, as_of: DateLike) -> DataFrame:
    """The whole summary: historical rules before the cutoff, current rules from it on.

    Two passes over the fact - cells, and event days before the cutoff - meet in one aggregation.
    """
    boundary = as_date(check_cutoff(cutoff))
    from_cells = _contributions(cohort_cells(fact), GRAINS, boundary)
    day = F.col("snapshot_date")
    states = {name: state.cast("bigint") for name, state in _event_states(as_of).items()}
    from_events = event_days(fact, boundary).select(
        *DIMENSIONS, F.inline(F.array(_contribution("Day", day, day, total=F.lit(1), **states)))
    )
    current_day = (F.col("period_type") == "Day") & (F.col("period_start") >= boundary)
    return _periods(from_cells.unionByName(from_events), current_day | F.col("first_day").isNotNull())
