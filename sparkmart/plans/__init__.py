"""Query registry: Spark plans and their independent SQL oracles."""
