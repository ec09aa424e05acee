"""varpair: two-sample variant comparison and peptide operators on Spark DataFrames."""
