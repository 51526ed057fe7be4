"""Run independent Spark actions side by side.

A small table's job cannot fill a large cluster; submitting independent jobs
from driver threads lets their tasks share the executors instead of queueing
job after job. Only jobs that write to different folders are run together.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def run_parallel(tasks: dict[str, Callable[[], T]], max_workers: int = 8) -> dict[str, T]:
    """Run each task in its own driver thread; re-raise the first failure.

    The threads inherit the caller's job group, so stopping a streaming query
    (or cancelling the group) also cancels what they run.
    """
    if len(tasks) <= 1:
        return {name: fn() for name, fn in tasks.items()}
    session = SparkSession.getActiveSession()
    inherit = inheritable_thread_target(session) if session is not None else inheritable_thread_target
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = {name: pool.submit(inherit(fn)) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}
