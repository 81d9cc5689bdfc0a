"""Entity search on Spark: typed entities, tables of searches, one distributed plan."""
