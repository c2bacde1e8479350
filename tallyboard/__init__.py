"""Posted-price board analytics expressed as Spark DataFrame plans."""
