"""Trying again what can fail for a moment."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")


def retried(call: Callable[[], T], tries: int = 3, first: float = 2.0, most: float = 30.0, on: tuple[type[Exception], ...] = (ConnectionError, TimeoutError), sleep: Callable[[float], None] = time.sleep) -> T:
    """The call's result; after an error of a kind in `on` it is tried again, each pause twice the one before."""
    for n in range(tries):
        try:
            return call()
        except on:
            if n + 1 == tries:
                raise
            sleep(min(most, first * 2**n))
    raise ValueError("tries must be positive")
