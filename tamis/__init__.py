"""Record refinery for semi-structured job-offer batches, written as Spark DataFrame operators.

Sub-packages
------------
``functions``  column expressions (no DataFrame, no action)
``operators``  DataFrame -> DataFrame transformations
``sources``    readers, lake writes, snapshots and audit logs
``plans``      operators composed into layers, and the bindings to the provided tables
``presets``    fixed rules of the offer domain (word lists, codes, schemas)
"""
