"""Where tables come from and go to: raw CSV, the parquet layers, the column dictionary."""
