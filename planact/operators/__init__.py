from planact.operators import (
    actuals,
    calendar,
    change,
    dedupe,
    plan,
    quality,
    telemetry,
    upsert,
)

__all__ = [
    "actuals",
    "calendar",
    "change",
    "dedupe",
    "plan",
    "quality",
    "telemetry",
    "upsert",
]
