"""Retail lakehouse operators written on Spark DataFrames and Structured Streaming.

Sub-packages:

* ``functions``  column expressions (hashes, JSON text, message payloads, topic names)
* ``sources``    batch scans and message streams
* ``operators``  DataFrame -> DataFrame operators shared by the models
* ``sinks``      table materialisation
* ``plans``      the bronze -> silver -> gold models and the batch job
* ``streaming``  the raw-ingest and landing streams
* ``testbed``    bronze inputs derived from the supplied test tables
"""
