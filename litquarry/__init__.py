"""Literature evidence analytics as Spark DataFrame operators."""
