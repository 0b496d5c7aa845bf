from planact.plans import (
    category_sums,
    combined,
    daily_report,
    feed_loads,
    legacy_report,
    material_report,
    plan_load,
)

__all__ = [
    "category_sums",
    "combined",
    "daily_report",
    "feed_loads",
    "legacy_report",
    "material_report",
    "plan_load",
]
