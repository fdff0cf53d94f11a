"""snaptally: analytics over dated snapshots of cumulative counters, on Spark."""

__version__ = "0.1.0"
