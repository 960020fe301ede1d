"""DataFrame-in, DataFrame-out operators: normalise, relevance, validation, signals,
de-duplication, pseudonymisation, reports and profiling."""
