"""Cloud-spend analytics on Spark: one DataFrame function per analytical question."""
