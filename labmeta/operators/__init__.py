"""DataFrame operators: alignment, delta, lookups, forms, answers, linked data and cohorts."""
