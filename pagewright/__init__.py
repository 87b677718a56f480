"""Evidence-preserving document analytics as PySpark DataFrame operators."""
