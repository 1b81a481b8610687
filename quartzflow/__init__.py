"""quartzflow: a PySpark-native analytics engine for transaction ledgers."""

__version__ = "0.1.0"
