"""Operations of a training-data pipeline: scoring, filtering, near-duplicates, tokens."""
