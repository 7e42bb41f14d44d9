"""Scripts for spark-submit."""
