"""weft: building, checking and evaluating knowledge graphs from structured documents on Spark."""

__version__ = "0.1.0"
