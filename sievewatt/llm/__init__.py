"""Operators for building training data, each on whole tables; their queries are in ``registry``."""
