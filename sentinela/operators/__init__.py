"""Row-level and set operators: cleaning, validation, integrity, duplicates, audit, series, clusters."""
