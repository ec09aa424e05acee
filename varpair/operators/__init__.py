"""DataFrame -> DataFrame operators (joins, pairing, sequences, k-mers, sets, intervals, summaries)."""
