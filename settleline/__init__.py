"""settleline: financial-transaction validation, enrichment, settlement, anomaly
detection and reporting as plain DataFrame-to-DataFrame Spark functions."""

from .config import DEFAULT_RULES, Rules

__all__ = ["Rules", "DEFAULT_RULES"]
