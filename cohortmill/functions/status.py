"""Task status expressions. A cohort is settled at the end of its opening day, ISO week or month."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortmill.functions.dates import check_grain, period_end

TODO, DOING, DONE = "TODO", "DOING", "DONE"


def live_status(end: Column, assignee: Column) -> Column:
    """Status right now: ended, else taken by someone, else open."""
    return (
        F.when(end.isNotNull(), F.lit(DONE))
        .when(assignee.isNotNull() & (assignee != ""), F.lit(DOING))
        .otherwise(F.lit(TODO))
    )


def settled(grain: str, event: Column, start: Column) -> Column:
    """Did ``event`` happen inside the settlement of the cohort opened on ``start``?

    Never NULL. The day grain asks for the very same day; week and month for "by the period's end".
    """
    if check_grain(grain) == "Day":
        return F.coalesce(event == start, F.lit(False))
    return F.coalesce(event <= period_end(grain, start), F.lit(False))


def cohort_status(
    grain: str,
    start: str = "task_start_date",
    claim: str = "task_claim_date",
    end: str = "task_end_date",
) -> Column:
    s, c, e = F.col(start), F.col(claim), F.col(end)
    return (
        F.when(settled(grain, e, s), F.lit(DONE))
        .when(settled(grain, c, s), F.lit(DOING))
        .otherwise(F.lit(TODO))
    )
