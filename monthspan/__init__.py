"""Monthly production panels on PySpark: raw monthly files in, an ML-ready entity-month panel out."""

from monthspan.panel import Panel

__all__ = ["Panel"]
