"""Documents to question banks on Spark: slicing, validation, merging, reports."""
