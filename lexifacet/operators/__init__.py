"""Match, rank, filter, sort, group, merge, excerpt and update operators."""
