"""lodestone: a PySpark-native record-linkage and text-processing engine.

Every operator is a plain ``DataFrame -> DataFrame`` function, so a plan stays
one declarative Catalyst query until an action runs it.
"""
