"""Table-in/table-out steps: cleaning, profiling, splits, metrics, drift, sampling, search."""
