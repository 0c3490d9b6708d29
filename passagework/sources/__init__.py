"""Readers and writers for question sets, shards, indexes and result logs."""
