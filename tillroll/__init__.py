"""Sales analytics for a fleet of trucks, expressed as Spark DataFrame jobs."""
