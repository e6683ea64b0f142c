"""helixframe: protein-structure datasets and analytics as Spark DataFrames."""
