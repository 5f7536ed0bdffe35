"""Operations of a training-data pipeline: dedup, filters, tokens and vector search."""
