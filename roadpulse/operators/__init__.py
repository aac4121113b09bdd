"""DataFrame in, DataFrame out. No operator collects rows."""
