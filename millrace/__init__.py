"""Real-time warehouse ingestion and daily sales reporting on Spark DataFrames."""

__version__ = "0.1.0"
