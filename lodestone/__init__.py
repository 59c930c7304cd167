"""Lodestone: typed columnar exchange between relational databases and Spark."""
