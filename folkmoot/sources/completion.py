"""Completion calls: a shared rate limit, retries with backoff, an injected transport."""

from __future__ import annotations

import time
from collections.abc import Callable

MOST_TRIES, FIRST_WAIT, LONGEST_WAIT, MARGIN = 5, 2.0, 60.0, 1.15


class RateLimiter:
    """At least ``MARGIN / rate`` seconds between calls; a penalty holds for all that follow."""

    def __init__(self, rate: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.interval, self.clock, self.sleep = int(1000 / rate * MARGIN) / 1000, clock, sleep
        self.next = clock()

    def acquire(self) -> None:
        if (wait := self.next - self.clock()) > 0:
            self.sleep(wait)
        self.next = self.clock() + self.interval

    def penalize(self, seconds: float) -> None:
        self.next = self.clock() + seconds


def complete(completer: Callable[[str, str], tuple[int, str, float | None]], prompt: str, text: str, limiter: RateLimiter) -> str | None:
    """The reply, or None. ``completer`` returns (status, reply, seconds to wait or None)."""
    wait = FIRST_WAIT
    for _ in range(MOST_TRIES):
        limiter.acquire()
        status, reply, asked = completer(prompt, text)
        if status < 400:
            return reply
        if status != 429 and status < 500:
            return None
        limiter.penalize(asked + 0.5 if asked is not None else wait)
        wait = min(2 * wait, LONGEST_WAIT)
    return None
