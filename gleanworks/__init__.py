"""Dataset curation and classifier evaluation on PySpark DataFrames."""
