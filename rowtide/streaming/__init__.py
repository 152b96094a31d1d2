"""The continuous job: one feed, five tables."""
