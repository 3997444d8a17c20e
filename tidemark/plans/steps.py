"""Running named steps in order and reporting on them."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import run_together

STEP_SCHEMA = "step string, status string, seconds double, detail string"

Step = tuple[str, Callable[[], object]]


def _outcome(name: str, action: Callable[[], object]) -> tuple:
    started = time.monotonic()
    try:
        outcome = action()
        return name, "OK", time.monotonic() - started, None if outcome is None else str(outcome)
    except Exception as problem:
        return name, "FAILED", time.monotonic() - started, f"{type(problem).__name__}: {problem}"


def run_steps(spark: SparkSession, steps: list[Step | list[Step]]) -> DataFrame:
    """Run until the first failure; steps after it are reported as skipped.

    A list of steps in the place of one holds steps that do not need each other:
    they run at the same time, and all of them run if one fails.
    """
    rows: list[tuple] = []
    for step in steps:
        together = step if isinstance(step, list) else [step]
        if any(status == "FAILED" for _, status, *_ in rows):
            rows += [(name, "SKIPPED", 0.0, None) for name, _ in together]
        elif len(together) == 1:
            rows.append(_outcome(*together[0]))
        else:
            rows += run_together(spark, {str(i): partial(_outcome, *s) for i, s in enumerate(together)}).values()
    return spark.createDataFrame(rows, STEP_SCHEMA)
