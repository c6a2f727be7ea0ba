"""lexmill: text corpus preparation, classification, title generation and scoring on Spark DataFrames."""
