"""Spark-native analytics over per-frame feature data: sampling, blocks, alignment, stores, comparison."""
