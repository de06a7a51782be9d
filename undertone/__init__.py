"""undertone: preparation and evaluation of speech-style training data on Spark.

Operators take and return DataFrames; nothing runs until the caller acts on the
result. Random choices are functions of hashed string keys, so a result depends
neither on partitioning nor on the size of the cluster.
"""
