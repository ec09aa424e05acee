"""Sinks: TSV, FASTA and one-row summaries (K1–K6)."""
