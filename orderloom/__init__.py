"""Order-lifecycle analytics on Spark: event log in, lifecycles, links and findings out."""
