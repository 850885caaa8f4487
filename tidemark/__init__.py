"""Batch analytics of orders on Spark.

Orders are read, stamped (Bronze), cleaned and deduplicated (Silver), modelled
as a star (Gold) and analysed. Every step takes and returns DataFrames, so
Catalyst sees whole plans; see README.md for the map of the package.
"""
