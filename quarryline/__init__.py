"""quarryline: evidence retrieval and corpus processing as Spark plans."""
