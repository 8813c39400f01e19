"""Row-level column expressions without shuffles, usable on batch and stream."""
