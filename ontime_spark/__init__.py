"""ontime_spark: airline on-time analytics as Spark DataFrame transformations.

Sub-packages
------------
sources    readers/writers: flight files, BTS CSV, station inventory, ISD text, ADS-B JSON,
           and the adapter that maps the driver's TPC-H-style tables onto flights.
functions  column expressions (no I/O, no shuffles): calendar, weather, route, text.
operators  DataFrame -> DataFrame steps: cleaning, features, encoders, joins, metrics.
plans      end-to-end batch jobs (train, score) composed from operators.
streaming  the scoring job in micro-batch form.
"""

__version__ = "0.1.0"
