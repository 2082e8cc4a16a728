"""The registered queries: inputs derived from the given tables, one plan per operator."""
