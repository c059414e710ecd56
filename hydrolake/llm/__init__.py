"""Operations for large training-data pipelines (text quality, deduplication, privacy, packing, archives)."""
