"""Sample ledger: laboratory sample records and sequencing files as Spark DataFrames."""
