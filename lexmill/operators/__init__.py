"""DataFrame in, DataFrame out."""
