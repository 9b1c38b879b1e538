"""Brand-mark analytics on Spark: domains, page candidates, image features, similarity graphs."""
