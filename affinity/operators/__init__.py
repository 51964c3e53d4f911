"""DataFrame operators, grouped by concern (prep, profile, signals,
popularity, evaluation, segments, als, tuning)."""
