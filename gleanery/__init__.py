"""Spark jobs over the tables a web harvest leaves behind.

Landed responses, harvested records, download manifests, failure queues, request logs and
the downloaded files come in as DataFrames; rows, identities, new records, download and
retry plans, drift findings, request health and the validation report go out as DataFrames.
"""
