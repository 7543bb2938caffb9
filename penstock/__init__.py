"""penstock: hydro-plant telemetry on Spark, as tables and as streams."""

__version__ = "0.1.0"
