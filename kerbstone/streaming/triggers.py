"""When a micro-batch starts, as keyword arguments of ``DataStreamWriter.trigger``."""

from __future__ import annotations

ASAP: dict = {}
EVERY_30_SECONDS = {"processingTime": "30 seconds"}
BACKLOG_THEN_STOP = {"availableNow": True}
