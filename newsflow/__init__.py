"""newsflow: build and analyse large news corpora with Spark DataFrames."""
