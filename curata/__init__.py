"""curata: curation and scoring of language-model training data on Spark DataFrames."""
