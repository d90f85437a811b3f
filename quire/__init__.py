"""quire: document preparation and retrieval data on Spark DataFrames."""
