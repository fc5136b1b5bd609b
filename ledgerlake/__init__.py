"""Layered banking analytics on Spark: typed loads, hash-keyed vault, marts, dashboards, live monitors."""

__version__ = "0.1.0"
