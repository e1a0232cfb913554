"""Readers and writers for manifests, sidecars, archives, logs and shard tables."""
