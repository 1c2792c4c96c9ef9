"""Column helpers and the shared kernels: keyed hashing, running sums, quantiles, moments."""
