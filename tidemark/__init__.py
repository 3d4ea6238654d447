"""Snapshot warehouse operators for Spark.

``functions``  Column-level rules: cleaning, bands, measures.
``sources``    Text snapshots, their catalogue, and the population reference.
``operators``  Generic DataFrame operators: ordering, lookups, versions, dedup.
``plans``      Dimensions, facts, views, questions, findings and checks.
``streaming``  Incremental pick-up of newly arrived files.
"""
