"""Analytics over open-source outreach data, expressed as Spark DataFrame work."""
