"""idlink: company-identifier linking over time, as Spark DataFrame jobs."""

__version__ = "0.1.0"
