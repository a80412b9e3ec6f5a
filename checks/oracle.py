"""Shared oracle sub-selects: the KPI rules written task by task, without the cell shortcut the library uses."""

from __future__ import annotations

from checks import adapter as a
from checks.base import Ctes

ctes = Ctes()

DIMS = "vx_type, region, plant, factory, line"
WEEK_START = "CAST(date_trunc('week', {d}) AS DATE)"
WEEK_KEY = "CAST(isoyear({d}) AS VARCHAR) || '-W' || lpad(CAST(weekofyear({d}) AS VARCHAR), 2, '0')"
WEEK_NAME = "'W' || CAST(weekofyear({d}) AS VARCHAR)"
MONTH_KEY = "strftime({d}, '%Y-%m')"
MONTH_NAME = "strftime({d}, '%b') || '.'"


def same(left: str, right: str, cols: str = DIMS) -> str:
    return " AND ".join(f"{left}.{c.strip()} = {right}.{c.strip()}" for c in cols.split(","))


def week_start(d: str) -> str:
    return WEEK_START.format(d=d)


def week_key(d: str) -> str:
    return WEEK_KEY.format(d=d)


def week_name(d: str) -> str:
    return WEEK_NAME.format(d=d)


def month_key(d: str) -> str:
    return MONTH_KEY.format(d=d)


def month_name(d: str) -> str:
    return MONTH_NAME.format(d=d)


ctes.add("b_task", a.BRONZE_TASKINST)
ctes.add("b_var", a.BRONZE_VARINST)
ctes.add("b_proc", a.BRONZE_PROCINST)
ctes.add("b_def", a.BRONZE_PROCDEF)
ctes.add("b_emp", a.BRONZE_EMPLOYEES)
ctes.add("m_line", a.MDM_LINE_DESC)
ctes.add("m_area", a.MDM_PROD_AREA)
ctes.add("m_plant", a.MDM_MFG_PLANT)
ctes.add("m_factory", a.MDM_FACTORY_AREA)
ctes.add("m_site", a.MDM_MFG_SITE)
ctes.add("fact", a.TASK_FACT)
ctes.add("labelled", f"""
SELECT f.*, {week_start('task_start_date')} + 6 AS week_end, last_day(task_start_date) AS month_end,
  CASE WHEN task_end_date IS NOT NULL THEN 'DONE' WHEN assignee_code <> '' THEN 'DOING' ELSE 'TODO' END AS task_status,
  CASE WHEN task_end_date = task_start_date THEN 'DONE' WHEN task_claim_date = task_start_date THEN 'DOING'
       ELSE 'TODO' END AS status_daily,
  CASE WHEN task_end_date <= {week_start('task_start_date')} + 6 THEN 'DONE'
       WHEN task_claim_date <= {week_start('task_start_date')} + 6 THEN 'DOING' ELSE 'TODO' END AS status_weekly,
  CASE WHEN task_end_date <= last_day(task_start_date) THEN 'DONE'
       WHEN task_claim_date <= last_day(task_start_date) THEN 'DOING' ELSE 'TODO' END AS status_monthly
FROM fact f
""")
ctes.add("counted", "SELECT * FROM labelled WHERE is_excluded = 0")

_STATES = ", ".join(
    f"count(CASE WHEN status_{g} = '{s.upper()}' THEN 1 END) AS {s}_{g}"
    for g in ("daily", "weekly", "monthly") for s in ("todo", "doing", "done")
)
LABELS = """CAST(year(snapshot_date) AS INT) AS calendar_year, CAST(isoyear(snapshot_date) AS INT) AS iso_year,
       CAST(weekofyear(snapshot_date) AS INT) AS iso_week, CAST(month(snapshot_date) AS INT) AS iso_month"""
ctes.add("milestones", f"""
SELECT *, {LABELS} FROM (
  SELECT task_start_date AS snapshot_date, {DIMS}, {_STATES} FROM counted GROUP BY task_start_date, {DIMS})
""")
ctes.add("backlog_tasks", f"""
SELECT task_id, {DIMS}, task_end_date, CAST(task_start_date + CAST(k AS INT) AS DATE) AS snapshot_date
FROM counted, range(7) steps(k)
""")
ctes.add("backlog", f"""
SELECT *, {LABELS} FROM (
  SELECT snapshot_date, {DIMS},
         count(DISTINCT CASE WHEN task_end_date IS NULL OR task_end_date > snapshot_date THEN task_id END) AS acc,
         count(DISTINCT task_id) AS acc_total_task
  FROM backlog_tasks GROUP BY snapshot_date, {DIMS})
""")
ctes.add("completed", f"""
SELECT m.snapshot_date, {', '.join('m.' + c.strip() for c in DIMS.split(','))},
       todo_daily + doing_daily + done_daily AS total_task,
       todo_daily, doing_daily, done_daily, todo_weekly, doing_weekly, done_weekly,
       todo_monthly, doing_monthly, done_monthly, acc, acc_total_task,
       m.calendar_year, m.iso_year, m.iso_week, m.iso_month
FROM milestones m LEFT JOIN backlog b ON m.snapshot_date = b.snapshot_date AND {same('m', 'b')}
""")
ctes.add("zero_days", f"""
SELECT b.* FROM backlog b ANTI JOIN completed c ON b.snapshot_date = c.snapshot_date AND {same('b', 'c')}
""")
QTYS = "total_qty, todo_qty, doing_qty, done_qty, doing_done_qty, acc_qty, acc_total_qty"
ctes.add("day_rows", f"""
SELECT 'Day' AS period_type, CAST(snapshot_date AS VARCHAR) AS period_key, snapshot_date, 0 AS sort_order,
       CAST(snapshot_date AS VARCHAR) AS period_name, {DIMS}, total_task AS total_qty, todo_daily AS todo_qty,
       doing_daily AS doing_qty, done_daily AS done_qty, doing_daily + done_daily AS doing_done_qty, acc AS acc_qty,
       acc_total_task AS acc_total_qty
FROM completed
UNION ALL
SELECT 'Day', CAST(snapshot_date AS VARCHAR), snapshot_date, 0, CAST(snapshot_date AS VARCHAR), {DIMS},
       0, 0, 0, 0, 0, acc, acc_total_task
FROM zero_days
""")


def _period_rows(grain: str, suffix: str, key: str, name: str, period: str) -> str:
    """Current regime: cohort sums, and the distinct union of the backlogs of days that have a milestone row."""
    return f"""
SELECT '{grain}' AS period_type, c.period_key, c.snapshot_date, 0 AS sort_order, {name} AS period_name,
       {', '.join('c.' + d.strip() for d in DIMS.split(','))}, total_qty, todo_qty, doing_qty, done_qty,
       doing_qty + done_qty AS doing_done_qty, todo_qty + doing_qty AS acc_qty, u.acc_total_qty, c.period_start
FROM (
  SELECT {period.format(d='snapshot_date')} AS period_start, {key.format(d='snapshot_date')} AS period_key,
         max(snapshot_date) AS snapshot_date, {DIMS}, CAST(sum(total_task) AS BIGINT) AS total_qty,
         CAST(sum(todo_{suffix}) AS BIGINT) AS todo_qty, CAST(sum(doing_{suffix}) AS BIGINT) AS doing_qty,
         CAST(sum(done_{suffix}) AS BIGINT) AS done_qty
  FROM completed GROUP BY 1, 2, {DIMS}
) c JOIN (
  SELECT {period.format(d='b.snapshot_date')} AS period_start, {', '.join('b.' + d.strip() for d in DIMS.split(','))},
         count(DISTINCT b.task_id) AS acc_total_qty
  FROM backlog_tasks b JOIN milestones m ON b.snapshot_date = m.snapshot_date AND {same('b', 'm')}
  GROUP BY 1, {', '.join('b.' + d.strip() for d in DIMS.split(','))}
) u ON c.period_start = u.period_start AND {same('c', 'u')}
"""


ctes.add("week_rows", _period_rows("Week", "weekly", WEEK_KEY, week_name("c.snapshot_date"), WEEK_START))
ctes.add("month_rows", _period_rows("Month", "monthly", MONTH_KEY, month_name("c.period_start"),
                                    "CAST(date_trunc('month', {d}) AS DATE)"))
ctes.add("event_rows", f"""
SELECT DISTINCT task_id, {DIMS}, task_claim_date, task_end_date, d AS snapshot_date FROM (
  SELECT *, task_start_date AS d FROM counted UNION ALL SELECT *, task_claim_date FROM counted
  UNION ALL SELECT *, task_end_date FROM counted) WHERE d IS NOT NULL
""")
ctes.add("hist_day_rows", f"""
SELECT 'Day' AS period_type, CAST(e.snapshot_date AS VARCHAR) AS period_key, e.snapshot_date, 0 AS sort_order,
       CAST(e.snapshot_date AS VARCHAR) AS period_name, {', '.join('e.' + c.strip() for c in DIMS.split(','))},
       total_qty, todo_qty, doing_qty, done_qty, doing_done_qty, COALESCE(acc, 0) AS acc_qty,
       COALESCE(acc_total_task, 0) AS acc_total_qty
FROM (
  SELECT snapshot_date, {DIMS}, count(*) AS total_qty,
    count(CASE WHEN snapshot_date < COALESCE(task_claim_date, task_end_date, DATE '{a.AS_OF}' + 1) THEN 1 END) AS todo_qty,
    count(CASE WHEN snapshot_date >= task_claim_date AND (task_end_date IS NULL OR snapshot_date < task_end_date)
          THEN 1 END) AS doing_qty,
    count(CASE WHEN snapshot_date >= task_end_date THEN 1 END) AS done_qty,
    count(CASE WHEN (snapshot_date >= task_claim_date AND (task_end_date IS NULL OR snapshot_date < task_end_date))
          OR snapshot_date >= task_end_date THEN 1 END) AS doing_done_qty
  FROM event_rows GROUP BY snapshot_date, {DIMS}
) e LEFT JOIN backlog b ON e.snapshot_date = b.snapshot_date AND {same('e', 'b')}
""")


def _hist_rows(grain: str, suffix: str, key: str, name: str, where: str) -> str:
    return f"""
SELECT '{grain}' AS period_type, {key} AS period_key, max(task_start_date) AS snapshot_date, 0 AS sort_order,
       {name} AS period_name, {DIMS}, count(*) AS total_qty,
       count(CASE WHEN status_{suffix} = 'TODO' THEN 1 END) AS todo_qty,
       count(CASE WHEN status_{suffix} = 'DOING' THEN 1 END) AS doing_qty,
       count(CASE WHEN status_{suffix} = 'DONE' THEN 1 END) AS done_qty,
       count(CASE WHEN status_{suffix} IN ('DOING', 'DONE') THEN 1 END) AS doing_done_qty,
       count(CASE WHEN status_{suffix} IN ('TODO', 'DOING') THEN 1 END) AS acc_qty, count(*) AS acc_total_qty
FROM counted WHERE {where} GROUP BY 2, 5, {DIMS}
"""


_START = "task_start_date"
_WEEK_CUT = week_start(f"DATE '{a.CUTOFF}'")
ctes.add("hist_week_rows", _hist_rows(
    "Week", "weekly", week_key(_START), week_name(_START),
    f"isoyear({_START}) = year({_START}) AND {_START} < {_WEEK_CUT}"))
ctes.add("hist_month_rows", _hist_rows(
    "Month", "monthly", month_key(_START), month_name(_START), f"{_START} < DATE '{a.CUTOFF}'"))
SUMMARY_COLS = f"period_type, period_key, snapshot_date, sort_order, period_name, {DIMS}, {QTYS}"
ctes.add("summary", f"""
SELECT {SUMMARY_COLS} FROM hist_day_rows WHERE snapshot_date < DATE '{a.CUTOFF}'
UNION ALL SELECT {SUMMARY_COLS} FROM hist_week_rows
UNION ALL SELECT {SUMMARY_COLS} FROM hist_month_rows
UNION ALL SELECT {SUMMARY_COLS} FROM day_rows WHERE snapshot_date >= DATE '{a.CUTOFF}'
UNION ALL SELECT {SUMMARY_COLS} FROM week_rows WHERE period_start >= {_WEEK_CUT}
UNION ALL SELECT {SUMMARY_COLS} FROM month_rows WHERE period_start >= DATE '{a.CUTOFF}'
""")
ctes.add("month_files", f"""
SELECT DISTINCT c.* EXCLUDE (week_end, month_end), m AS file_month,
       CASE WHEN m = {month_key('task_start_date')} THEN 1 ELSE 0 END AS in_month_cohort
FROM (SELECT *, {month_key('task_start_date')} AS m FROM counted
      UNION ALL SELECT *, {month_key('task_claim_date')} FROM counted WHERE {month_key('task_claim_date')} < '{a.CUTOFF[:7]}'
      UNION ALL SELECT *, {month_key('task_end_date')} FROM counted WHERE {month_key('task_end_date')} < '{a.CUTOFF[:7]}') c
""")
