"""Lead-data operators expressed as Spark DataFrame plans."""
