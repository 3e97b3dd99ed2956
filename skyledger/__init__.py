"""Surface-weather observation engine on PySpark: sources, quality control, daily products, fabric, releases."""

__version__ = "0.1.0"
