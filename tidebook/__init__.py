"""Order-book analytics on Spark: archives, books, features, trust and research."""
