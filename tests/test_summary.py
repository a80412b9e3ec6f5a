"""The summary against a brute force that follows the rules task by task, with sets."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cohortmill.operators import cohort, summary
from cohortmill.plans import recon

DAY = dt.timedelta(days=1)


def status(end_of_period, start, claim, end, day_grain):
    if day_grain:
        return "done" if end == start else "doing" if claim == start else "todo"
    return ("done" if end and end <= end_of_period else "doing" if claim and claim <= end_of_period else "todo")


def bounds(grain, d):
    if grain == "Day":
        return d, d
    if grain == "Week":
        monday = d - DAY * d.weekday()
        return monday, monday + DAY * 6
    first = d.replace(day=1)
    return first, (first + DAY * 32).replace(day=1) - DAY


def brute(tasks, cutoff, as_of):
    """Rows as {(grain, period start, plant): (snapshot, total, todo, doing, done, acc, acc_total)}."""
    live = [t for t in tasks if not t[5]]
    opened = defaultdict(set)
    for t in live:
        opened[(t[1], t[4])].add(t[0])
    backlog = defaultdict(set)
    for t in live:
        for k in range(7):
            backlog[(t[1] + DAY * k, t[4])].add(t)
    out = {}
    for (d, plant), members in backlog.items():
        own = [t for t in live if t[1] == d and t[4] == plant]
        count = defaultdict(int)
        for t in own:
            count[status(d, t[1], t[2], t[3], True)] += 1
        acc = sum(t[3] is None or t[3] > d for t in members)
        if d >= cutoff:
            out[("Day", d, plant)] = (d, len(own), count["todo"], count["doing"], count["done"], acc, len(members))
    events = defaultdict(set)
    for t in live:
        for d in {t[1], t[2], t[3]} - {None}:
            events[(d, t[4])].add(t)
    for (d, plant), members in events.items():
        if d < cutoff:
            todo = sum(d < (t[2] or t[3] or as_of + DAY) for t in members)
            doing = sum(t[2] is not None and d >= t[2] and (t[3] is None or d < t[3]) for t in members)
            done = sum(t[3] is not None and d >= t[3] for t in members)
            back = backlog.get((d, plant), set())
            acc = sum(t[3] is None or t[3] > d for t in back)
            out[("Day", d, plant)] = (d, len(members), todo, doing, done, acc, len(back))
    for grain in ("Week", "Month"):
        groups = defaultdict(list)
        for t in live:
            start, _ = bounds(grain, t[1])
            current = start >= bounds(grain, cutoff)[0]
            if grain == "Week" and not current and t[1].isocalendar()[0] != t[1].year:
                continue
            groups[(start, t[4])].append(t)
        for (start, plant), members in groups.items():
            last = bounds(grain, start)[1]
            count = defaultdict(int)
            for t in members:
                count[status(last, t[1], t[2], t[3], False)] += 1
            if start >= bounds(grain, cutoff)[0]:
                days = {t[1] for t in members}
                union = set().union(*[{m[0] for m in backlog[(d, plant)]} for d in days])
                acc_total = len(union)
            else:
                acc_total = len(members)
            out[(grain, start, plant)] = (max(t[1] for t in members), len(members), count["todo"], count["doing"],
                                          count["done"], count["todo"] + count["doing"], acc_total)
    return out


def as_dict(df):
    got = {}
    for r in df.collect():
        start = bounds(r.period_type, r.snapshot_date)[0]
        key = (r.period_type, start, r.plant)
        assert key not in got, "duplicate period row"
        got[key] = (r.snapshot_date, r.total_qty, r.todo_qty, r.doing_qty, r.done_qty, r.acc_qty, r.acc_total_qty)
        assert r.doing_done_qty == r.doing_qty + r.done_qty
    return got


def random_tasks(seed, n=150, hot=0.5):
    rng = random.Random(seed)
    first = dt.date(2025, 12, 8)
    tasks = []
    for i in range(n):
        start = first + DAY * rng.choice([rng.randrange(60), rng.randrange(3) * 20])
        claim = start + DAY * rng.randrange(12) if rng.random() < 0.7 else None
        end = start + DAY * rng.randrange(25) if rng.random() < 0.6 else None
        plant = "HOT" if rng.random() < hot else f"P{rng.randrange(4)}"
        tasks.append((f"t{i}", start, claim, end, plant, int(rng.random() < 0.1)))
    return tasks


def frame(make_tasks, tasks):
    return make_tasks(*[(t[0], str(t[1]), t[2] and str(t[2]), t[3] and str(t[3]), t[4], t[5]) for t in tasks])


@pytest.mark.parametrize("seed, cutoff", [(1, "2026-01-01"), (2, "2025-12-01"), (3, "2026-03-01"), (4, "2026-01-01")])
def test_summary_equals_brute_force(spark, make_tasks, seed, cutoff):
    tasks = random_tasks(seed)
    as_of = dt.date(2026, 3, 1)
    got = as_dict(summary.task_summary(frame(make_tasks, tasks), cutoff, as_of))
    assert got == brute(tasks, dt.date.fromisoformat(cutoff), as_of)


def test_week_backlog_counts_only_days_with_an_opening(spark, make_tasks):
    """Opened Friday before: in the week's union through Thursday only if the week has an opening by then."""
    early = make_tasks(("a", "2026-05-08", None, None), ("b", "2026-05-13", None, None))   # Friday, then Wednesday
    late = make_tasks(("a", "2026-05-08", None, None), ("b", "2026-05-15", None, None))    # Friday, then Friday
    for tasks, expected in ((early, 2), (late, 1)):
        week = summary.week_summary(cohort.cohort_cells(tasks)).where("period_key = '2026-W20'").first()
        assert (week.total_qty, week.acc_total_qty) == (1, expected)


def test_cross_year_week_is_kept_or_dropped(spark, make_tasks):
    cells = cohort.cohort_cells(make_tasks(("a", "2025-12-29", None, None)))
    assert summary.week_summary(cells).first().period_key == "2026-W01"
    assert summary.historical_cohort_summary(cells, "Week").count() == 0
    assert summary.historical_cohort_summary(cells, "Week", drop_cross_year=False).first().period_key == "2026-W01"


def test_claim_after_end_counts_as_todo_and_done_on_event_days(spark, make_tasks):
    tasks = make_tasks(("a", "2025-12-01", "2025-12-05", "2025-12-03"))
    row = summary.historical_day_counts(tasks, "2026-01-01").where("snapshot_date = '2025-12-03'").first()
    assert (row.total_qty, row.todo_qty, row.doing_qty, row.done_qty) == (1, 1, 0, 1)


def test_cutoff_must_start_a_month():
    with pytest.raises(ValueError):
        summary.check_cutoff("2026-04-02")


def test_invariants(spark, make_tasks):
    cells = cohort.cohort_cells(frame(make_tasks, random_tasks(9)))
    whole = summary.current_summary(cells)
    assert recon.conservation_violations(whole).count() == 0
    assert whole.where(F.col("acc_qty") > F.col("acc_total_qty")).count() == 0
    by_month = whole.where("period_type = 'Day'").groupBy(F.date_format("snapshot_date", "yyyy-MM").alias("m")).agg(F.sum("total_qty").alias("t"))
    months = whole.where("period_type = 'Month'").groupBy(F.col("period_key").alias("m")).agg(F.sum("total_qty").alias("t"))
    assert by_month.where("t > 0").exceptAll(months).count() == 0 and months.exceptAll(by_month).count() == 0


def test_completion_in_one_aggregation_equals_the_join(spark, make_tasks):
    cells = cohort.cohort_cells(frame(make_tasks, random_tasks(5)))
    joined = cohort.completion(cohort.milestone(cells), cohort.acc_rolling(cells))
    fused = cohort.completion_from_cells(cells).select(*joined.columns)
    assert joined.exceptAll(fused).count() == 0 and fused.exceptAll(joined).count() == 0


def test_the_fact_is_aggregated_before_it_is_shuffled(spark, make_tasks):
    plan = cohort.cohort_cells(make_tasks(("a", "2026-05-08", None, None)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2


def test_partitioning_of_the_input_does_not_matter(spark, make_tasks):
    tasks = frame(make_tasks, random_tasks(7, hot=0.9))
    one = as_dict(summary.task_summary(tasks.coalesce(1), "2026-01-01", "2026-03-01"))
    many = as_dict(summary.task_summary(tasks.repartition(13), "2026-01-01", "2026-03-01"))
    assert one == many
