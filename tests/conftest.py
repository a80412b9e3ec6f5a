from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortmill.session import build_session  # noqa: E402

TASK_DDL = (
    "task_id string, vx_type string, region string, plant string, factory string, line string, "
    "task_start_date date, task_claim_date date, task_end_date date, is_excluded int, assignee_code string"
)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, 4, **{"spark.driver.memory": "4g"})
    yield session
    session.stop()


def day(text: str | None) -> dt.date | None:
    return dt.date.fromisoformat(text) if text else None


@pytest.fixture
def make_tasks(spark):
    """Tasks from (id, start, claim, end[, plant[, excluded]])."""
    def build(*rows):
        full = []
        for r in rows:
            task, start, claim, end, *rest = r
            plant = rest[0] if rest else "P1"
            excluded = rest[1] if len(rest) > 1 else 0
            full.append((task, "V3", "R1", plant, "F1", "L1", day(start), day(claim), day(end), excluded, "E1"))
        return spark.createDataFrame(full, TASK_DDL)

    return build
