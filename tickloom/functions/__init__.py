"""Column helpers: casts that never raise, null-safe ratios, labels and row frames."""
