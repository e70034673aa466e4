"""Operations of a training-data pipeline: scoring, deduplication, filtering, tokens, archives, mixing, search."""
