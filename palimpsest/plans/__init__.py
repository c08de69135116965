"""The six extraction jobs, each a function from revisions to features and counters."""
