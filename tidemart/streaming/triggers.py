"""When a stream runs: drain the backlog and stop, or keep polling."""

from __future__ import annotations

DRAIN = {"availableNow": True}


def every(interval: str = "30 seconds") -> dict[str, str]:
    return {"processingTime": interval}
