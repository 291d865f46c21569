"""Job-market analytics as ordinary Spark DataFrame jobs.

``functions``  Column -> Column expressions (parsing, vocabularies, display)
``operators``  DataFrame -> DataFrame building blocks (dedup, joins, top-n, shares)
``sources``    CSV / JSON readers, table store, scratch space
``streaming``  incremental ingest of newly arrived files
``plans``      bronze -> silver -> gold tables, market reports and dashboard panels
"""
