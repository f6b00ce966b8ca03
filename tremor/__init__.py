"""Regional impact analytics on Spark: text and JSON feeds to counts per place."""
