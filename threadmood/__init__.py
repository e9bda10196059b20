"""Comment-sentiment analytics on Spark: clean, tokenise, train, score, report."""
