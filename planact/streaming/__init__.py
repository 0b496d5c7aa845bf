from planact.streaming import corrections, ingest, progress, windows

__all__ = ["corrections", "ingest", "progress", "windows"]
