from planact.sinks import reports, tables

__all__ = ["reports", "tables"]
