"""Relationship-tuple change feeds on Spark: parse, audit, fold to state, replicate, count."""
