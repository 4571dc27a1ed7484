"""oreflow: bronze, silver and gold analytics for an e-commerce platform, on Spark.

The package is a set of ``DataFrame -> DataFrame`` functions. Batch jobs and
streams share them, so each rule is written once.
"""
