"""Run independent Spark actions side by side.

One table's last tasks leave most of a cluster idle; the next table's first
tasks fill it when both jobs are submitted from their own threads.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

MOST_AT_ONCE = 8


def together(tasks: Mapping[str, Callable[[], T]]) -> tuple[dict[str, T], dict[str, Exception]]:
    """Results and errors by name, in the order of the tasks; one error stops no other task."""
    if not tasks:
        return {}, {}
    in_session = inheritable_thread_target(SparkSession.active())
    results, errors = {}, {}
    with ThreadPoolExecutor(max_workers=min(len(tasks), MOST_AT_ONCE)) as pool:
        waiting = {name: pool.submit(in_session(task)) for name, task in tasks.items()}
        for name, future in waiting.items():
            try:
                results[name] = future.result()
            except Exception as error:
                errors[name] = error
    return results, errors


def all_together(tasks: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Results by name; the first error is raised once all tasks have ended."""
    results, errors = together(tasks)
    for error in errors.values():
        raise error
    return results
