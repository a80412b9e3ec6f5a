"""A check: a query, and the SQL text that must return the same rows (None where SQL cannot say it)."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from checks.adapter import duck


@dataclass(frozen=True)
class Check:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Ctes:
    """Named sub-selects; ``sql(body)`` prefixes the ones the body needs, in definition order."""

    def __init__(self) -> None:
        self._parts: dict[str, str] = {}

    def add(self, name: str, sql: str) -> None:
        self._parts[name] = duck(sql)

    def rebased(self, first: Sequence[str], **replaced: str) -> Ctes:
        """The same sub-selects with some replaced; those of ``first`` come before all others."""
        other = Ctes()
        rest = [name for name in self._parts if name not in first]
        for name in (*first, *rest):
            other.add(name, replaced.get(name, self._parts[name]))
        return other

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(self._parts)

    def sql(self, body: str) -> str:
        body = duck(body)
        needed: set[str] = set()

        def visit(text: str) -> None:
            for name in self._parts:
                if name not in needed and re.search(rf"\b{name}\b", text):
                    needed.add(name)
                    visit(self._parts[name])

        visit(body)
        parts = [f"{name} AS (\n{sql}\n)" for name, sql in self._parts.items() if name in needed]
        return f"WITH {', '.join(parts)}\n{body}" if parts else body
