"""DataFrame operators: splits, ranges and buckets, category ranks, confusion metrics, vectors."""
