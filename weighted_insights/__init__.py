"""Survey-weighted analytics on Spark DataFrames.

Subpackages:

* ``sources``   readers and sinks
* ``functions`` row-wise column expressions (cleaning, derived features)
* ``operators`` aggregates, curves, profiles, splits, fitted preprocessing
* ``plans``     model training, clustering and the two end-to-end jobs
* ``catalog``   the registered queries over the driver's tables, with their SQL twins
"""
