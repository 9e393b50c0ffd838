"""Member activity analytics expressed as Spark DataFrame plans."""
