"""voltrail — station equipment-energy KPIs as Spark DataFrame plans."""

__version__ = "0.1.0"
