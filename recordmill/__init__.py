"""Record-processing engine on PySpark: corpus analytics, text features, scoring, gating and streaming status logs."""

__version__ = "0.1.0"
