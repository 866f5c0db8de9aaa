"""Operators of a training-data pipeline: quality classifier, sharding,
language identification, near-duplicate and repeat removal, secret scans,
packing, vector search and subword encoding. One module per operator; nothing
else in the library imports this subpackage."""
