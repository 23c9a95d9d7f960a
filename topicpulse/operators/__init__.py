"""DataFrame operators: cleaning, similarity, dedup, term statistics, trends, sentiment."""
