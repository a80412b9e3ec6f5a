"""Workflow-task analytics on Spark: every operator is a DataFrame -> DataFrame function.

Nothing here reads the clock: ``as_of``, ``cutoff`` and window bounds are arguments.
"""

DIMENSIONS = ("vx_type", "region", "plant", "factory", "line")
"""The five levels every KPI is grouped by."""
