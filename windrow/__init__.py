"""Windrow: a medallion analytics engine for on-time flight records on PySpark.

Operators are plain functions from DataFrame to DataFrame:

* ``windrow.functions``  column builders shared by the operators
* ``windrow.sources``    CSV, fixture and snapshot-table readers and writers
* ``windrow.operators``  cleaning, features, KPIs, selection, models, maintenance
* ``windrow.plans``      silver and gold plans, the layer runner, the query registry
"""
