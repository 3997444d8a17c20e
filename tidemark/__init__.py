"""tidemark: warehouse building blocks expressed as Spark DataFrame plans."""
