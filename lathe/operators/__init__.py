"""DataFrame operators. Each takes and returns DataFrames; fitted state is a
small DataFrame or a tiny driver-side dict of parameters."""
