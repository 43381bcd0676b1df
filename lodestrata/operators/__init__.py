"""DataFrame operators: each takes and returns DataFrames and collects nothing but bounded control values."""
