"""Spark-native refinement of tabular sources into audited, queryable statistical cubes."""
