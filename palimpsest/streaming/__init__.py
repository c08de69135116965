"""Row-wise extraction over revisions that arrive as a stream."""
