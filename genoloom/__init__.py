"""Genoloom: a Spark-first analytics engine for variant-effect tables.

Operators are lazy ``DataFrame -> DataFrame`` functions; nothing collects rows to the driver
except header lines and single-row quality counts.
"""

__version__ = "0.1.0"
