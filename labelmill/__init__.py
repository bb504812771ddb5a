"""Spark jobs for building, profiling and auditing labelled program corpora.

``functions``  column expressions, JVM-side
``operators``  DataFrame -> DataFrame jobs
``sources``    readers and writers
``plans``      the registered queries and their table bindings
``streaming``  incremental ingest
"""
