"""formflow: form and study data as entity-attribute-value rows, on Spark.

Every public function takes and returns lazy DataFrames; the work is planned by
Catalyst and stays in the JVM (no Python UDF anywhere in the package).
"""
