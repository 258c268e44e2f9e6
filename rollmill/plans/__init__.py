"""The batch job: which periods to close, and the snapshot of each."""
