"""Document-processing ledger: registry, attempts, audits and extraction as Spark DataFrames."""
