"""DataFrame-in, DataFrame-out operators. No actions inside."""
