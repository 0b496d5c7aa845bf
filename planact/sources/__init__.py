from planact.sources import grids, ledger, movements, star_views, tables, telemetry

__all__ = ["grids", "ledger", "movements", "star_views", "tables", "telemetry"]
