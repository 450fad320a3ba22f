"""Composed plans: the staged DAG, registered queries, their SQL twins."""
