"""Review-text cleaning, lexicon scoring and feature jobs on Spark."""
