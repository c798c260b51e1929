"""Daily market analytics as DataFrame-to-DataFrame steps on Spark."""
