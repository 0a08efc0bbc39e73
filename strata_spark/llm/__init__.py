"""Operations for training-data pipelines: tokens, duplicates, contamination, secrets, quality."""
