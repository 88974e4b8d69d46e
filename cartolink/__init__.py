"""cartolink: similarity retrieval and record linkage as Spark DataFrame plans."""
