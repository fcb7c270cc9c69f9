"""Hot and cold device analytics on PySpark.

Layers, lowest first: ``functions`` (column expressions), ``sources`` (message
streams, the device dimension, two-tier tables), ``operators`` (DataFrame to
DataFrame steps), ``plans`` (the operational queries) and ``streaming`` (the
standing jobs that keep the tables fed).
"""
