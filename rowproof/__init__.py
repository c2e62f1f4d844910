"""Record validation, error ledgers and incremental star-schema loads on Spark DataFrames."""
