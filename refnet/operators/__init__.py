"""DataFrame-in, DataFrame-out operators of the reference network."""
