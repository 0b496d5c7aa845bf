"""What every report reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Inputs:
    """The five tables of the domain, stored or derived."""

    materials: DataFrame
    movements: DataFrame
    plan: DataFrame
    shutdown: DataFrame
    telemetry: DataFrame
