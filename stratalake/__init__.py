"""stratalake: layered multi-tenant analytics expressed as Spark DataFrame jobs."""
