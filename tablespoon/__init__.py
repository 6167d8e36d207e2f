"""Restaurant sales lakehouse on Spark: landed JSON -> bronze -> staging -> marts."""
