"""caudalix: licence and corpus analytics as declarative PySpark plans."""
