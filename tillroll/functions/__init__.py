"""Column helpers: exact ratios, wall-clock time, business predicates, labels."""
