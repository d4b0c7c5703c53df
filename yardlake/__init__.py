"""Container-yard analytics on Spark: event cleaning, cycles, status, KPIs and their streams."""
