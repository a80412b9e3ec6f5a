"""All checks, in one list with unique names."""

from __future__ import annotations

from checks import daily_job, gold, loading, reconciling, reporting, silver

CHECKS = [*gold.CHECKS, *silver.CHECKS, *reporting.CHECKS, *reconciling.CHECKS, *loading.CHECKS, *daily_job.CHECKS]
