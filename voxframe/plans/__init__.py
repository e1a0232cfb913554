"""Whole jobs composed of the operators: split plan, shard tables, batches, evaluation."""
