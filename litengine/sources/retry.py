"""Retries with exponential backoff and jitter."""

from __future__ import annotations

import logging
import random
import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column
from pyspark.sql import functions as F

from litengine.functions.text import RETRIABLE_MARKS, shortened

log = logging.getLogger("litengine")
T = TypeVar("T")
#: Kinds of error that a remote source gives in passing.
RETRIABLE_ERRORS: tuple[type[BaseException], ...] = (OSError, RuntimeError, TimeoutError, ConnectionError)


def retriable_message(text: str) -> bool:
    low = text.lower()
    return any(mark in low for mark in RETRIABLE_MARKS)


def retriable(error: BaseException) -> bool:
    return isinstance(error, RETRIABLE_ERRORS) or retriable_message(str(error))


def backoff(base, attempt):  # noqa: ANN001, ANN201
    """Seconds after failed attempt 0, 1 …, without the jitter; numbers or columns."""
    return base * 2**attempt


def delays(attempts: int, base: float = 1.0, jitter: Callable[[], float] = random.random) -> list[float]:
    """Seconds before the second, third … attempt."""
    return [backoff(base, n) + jitter() for n in range(attempts - 1)]


def delay_columns(base: Column, attempts: int) -> Column:
    """The same delays without the jitter as an array column."""
    return F.array(*(backoff(base, n) for n in range(attempts - 1)))


def retrying(call: Callable[[], T], attempts: int = 5, base: float = 1.0, worth: Callable[[BaseException], bool] = retriable, wait: Callable[[float], None] | None = None) -> T:
    """The call's result; the last error, or the first that is not worth another attempt, is raised."""
    pauses = delays(attempts, base)
    for n in range(attempts):
        try:
            return call()
        except Exception as error:
            if n == attempts - 1 or not worth(error):
                raise
            log.warning("attempt %d of %d failed, again in %.1f s: %s", n + 1, attempts, pauses[n], shortened(str(error)))
            (wait or time.sleep)(pauses[n])
    raise ValueError("attempts must be positive")
