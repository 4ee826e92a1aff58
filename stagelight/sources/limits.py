"""Rate limits of sources: token buckets that refill all the time."""

from __future__ import annotations

import time
from collections.abc import Callable


class Bucket:
    """Holds up to `capacity` tokens, refilled over `period` seconds. A cost above the capacity waits for a full bucket and
    leaves a debt, so that one large payload never waits for ever."""

    def __init__(self, capacity: float, period: float = 60.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.capacity, self.rate, self.clock, self.sleep = capacity, capacity / period, clock, sleep
        self.tokens, self.last = capacity, clock()

    def take(self, cost: float) -> float:
        """Waits until the cost is there and takes it; how long it waited."""
        waited = 0.0
        while True:
            now = self.clock()
            self.tokens = min(self.capacity, self.tokens + (now - self.last) * self.rate)
            self.last = now
            need = min(cost, self.capacity) - self.tokens
            if need <= 1e-9:
                self.tokens -= cost
                return waited
            pause = max(need / self.rate, 0.001)
            self.sleep(pause)
            waited += pause


class Limits:
    """Requests and bytes a minute; none or 0 is no limit. `share` is one part's share where a source is fetched by several."""

    def __init__(self, requests_per_min: float | None = None, bytes_per_min: float | None = None, share: float = 1.0, **clocks: Callable):
        self.requests = Bucket(max(1.0, requests_per_min * share), **clocks) if requests_per_min else None
        self.bytes = Bucket(bytes_per_min * share, **clocks) if bytes_per_min else None

    def acquire(self, size: int = 0) -> None:
        if self.requests:
            self.requests.take(1)
        if self.bytes and size:
            self.bytes.take(size)

    def used(self, size: int) -> None:
        """Accounts for what an answer turned out to hold."""
        if self.bytes and size:
            self.bytes.take(size)
