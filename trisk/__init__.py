"""trisk: triangle counting and stream sketching as Spark DataFrame jobs.

Sub-packages:
  functions  column expressions for the hash families (colours, sketch columns, signs)
  sources    edge lists, the order graph and item streams read from tables
  operators  graph orientation, triangle counts and estimates, count sketch, batch tables
  streaming  the same operators on Structured Streaming micro-batches
  plans      the registered queries over the test tables and their SQL oracles
"""

__version__ = "0.1.0"
