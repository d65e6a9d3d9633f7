"""Independent ANSI SQL for every registered query that SQL can express."""

from __future__ import annotations

from oracles.checks import checks
from oracles.generation import generation
from oracles.jobs import jobs
from oracles.questions import questions
from oracles.tracking import tracking


def all_oracles() -> dict[str, str]:
    return {**questions(), **checks(), **tracking(), **jobs(),
            **generation()}
