"""Document-fact analytics on Spark: segmenting, linking, reconciling, describing."""
