"""adtally: advertising-delivery analytics expressed as Spark DataFrame jobs."""
