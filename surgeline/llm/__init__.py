"""Operations of a training-data pipeline: tokens, shards, duplicates, filters, search, mixing."""
