"""strata: object-lifecycle analytics over versioned map history, on Spark."""

__version__ = "0.1.0"
