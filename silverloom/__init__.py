"""silverloom: raw CSV with JSON cells -> typed tables -> answers, as plain Spark plans.

Every public function takes DataFrames (or a SparkSession and a path) and returns a lazy
DataFrame, so Catalyst sees one declarative plan. Sub-packages:

* ``functions``  column expressions: tolerant casts, JSON cells, null imputation
* ``operators``  frame -> frame operators: explode, conform, DML, SCD2, quality, ordering
* ``sources``    readers and writers
* ``plans``      the eight silver builders and the five analytic questions
* ``streaming``  incremental ingest with the same builders
"""
