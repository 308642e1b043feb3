"""Intervention-effect analytics on Spark DataFrames.

Sub-packages
------------
``sources``    readers, writers and the star-schema test mapping
``functions``  column expressions (Student t, flags, split buckets)
``operators``  DataFrame -> DataFrame building blocks
``plans``      whole runs: train every model, score and publish flags
``registry``   the queries checked against SQL by the driver
"""
