"""Streaming: nothing to build.

The reference has no streams, watermarks, windows over time or state.  The
row-wise operators (genotype, discordance and HGVS expressions, NULL-keeping
filters, context windows) are plain column expressions, so they apply to a
streaming DataFrame unchanged (see ``tests/test_io.py::test_rowwise_on_stream``);
operators that check a side's size with a count (k-mer anti joins, sized
broadcasts) need a static DataFrame.
"""
