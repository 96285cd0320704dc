"""External tools behind rows: one command for each row, its outcome as a status."""

from __future__ import annotations

import os
import signal
import subprocess
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from voxelforge.functions import fixed as X

_FIELDS = "key string, status string, code string, exit_code int, seconds double, log string"


def run_one(argv: list[str], timeout: float) -> tuple[str | None, int | None, float, str]:
    """(failure code or None, exit code, seconds, log): a command in a process group of its own, killed as a whole when time is up."""
    import time

    began = time.time()
    try:
        p = subprocess.Popen(argv, stdout=subprocess.PIPE, stderr=subprocess.STDOUT, text=True, start_new_session=True)
    except OSError as x:
        return "launch_failed", None, time.time() - began, str(x)
    try:
        log, _ = p.communicate(timeout=timeout)
    except subprocess.TimeoutExpired:
        os.killpg(p.pid, signal.SIGKILL)
        log, _ = p.communicate()
        return "timeout", p.returncode, time.time() - began, log or ""
    return ("nonzero_exit" if p.returncode else None), p.returncode, time.time() - began, log


def run_tool(rows: DataFrame, argv: Callable[[str], list[str]], timeout: float, check: Callable[[str], str | None] | None = None) -> DataFrame:
    """Runs argv(key) for each row's key on the executors. check(log) may give a failure code for a log that reads as one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key in frame["key"]:
                code, exit_code, seconds, log = run_one(argv(key), timeout)
                code = code or (check(log) if check else None)
                assert code is None or code in X.TOOL_FAILURES
                out.append((key, "unknown_failed" if code else "success", code, exit_code, seconds, log[-10_000:]))
            yield pd.DataFrame(out, columns=["key", "status", "code", "exit_code", "seconds", "log"])

    return rows.select(rows.columns[0]).toDF("key").mapInPandas(run, _FIELDS)
