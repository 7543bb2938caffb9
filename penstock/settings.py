"""Limits, constants and job settings. Plain values, read on the driver only."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Limits:
    """Operating limits. Fixed values of the 3.0 event generation."""

    temperature_critical_c: float = 80.0
    temperature_attention_c: float = 72.0
    vibration_critical_mm_s: float = 4.5
    vibration_attention_mm_s: float = 3.0
    efficiency_critical: float = 0.75
    efficiency_attention: float = 0.83
    critical_rate_pct: float = 5.0
    wear_critical: float = 0.65
    oee_min: float = 0.70


LIMITS = Limits()
# The 2.0 event generation used lower temperature and efficiency limits.
LIMITS_V2 = replace(
    LIMITS, temperature_critical_c=78.0, temperature_attention_c=70.0, efficiency_attention=0.82
)


@dataclass(frozen=True)
class EfficiencyCurve:
    """Bell curve of expected efficiency over relative load. Fixed values per event generation."""

    drop: float = 0.04
    gain: float = 0.05
    optimum: float = 0.72
    width: float = 0.025
    low_head_optimum: float = 0.78
    low_head_width: float = 0.030
    low_head_below_m: float = 25.0
    floor: float = 0.75
    ceiling: float = 0.97
    digits: int | None = 5


CURVE = EfficiencyCurve()
CURVE_V2 = EfficiencyCurve(
    drop=0.05,
    gain=0.06,
    low_head_optimum=0.72,
    low_head_width=0.025,
    floor=0.72,
    ceiling=0.96,
    digits=None,
)


@dataclass(frozen=True)
class Settings:
    """Job settings; each one can be overridden from an environment variable of the same name."""

    bootstrap_servers: str = "localhost:9092"
    topic: str = "plant-telemetry"
    water_density_kg_m3: float = 1000.0
    gravity_m_s2: float = 9.81
    step_seconds: int = 1
    watermark: str = "10 minutes"
    raw_trigger_seconds: int = 120
    curated_trigger_seconds: int = 30
    kpi_trigger_seconds: int = 30
    # 0: everything there is
    max_offsets_per_trigger: int = 0
    max_files_per_trigger: int = 0
    raw_retention_days: int = 2
    curated_retention_hours: int = 6
    kpi_retention_days: int = 7
    raw_maintenance_batches: int = 5
    curated_maintenance_batches: int = 10
    kpi_maintenance_batches: int = 20
    curated_fresh_seconds: int = 300
    kpi_fresh_seconds: int = 600

    @classmethod
    def from_env(cls, environ: Mapping[str, str] = os.environ) -> Settings:
        """Overrides from upper-case variables; a value that does not parse is an error."""
        found = {}
        for field in fields(cls):
            text = environ.get(field.name.upper())
            if text is not None:
                found[field.name] = type(field.default)(text)
        return cls(**found)
