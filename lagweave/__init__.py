"""Time-course and regulatory-network analytics as Spark DataFrame operators."""
