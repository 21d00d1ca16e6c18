"""tally: ledger analytics on Spark.

Reads bank and card exports, checks their quality, standardises and loads
them incrementally, unifies them into one categorised ledger and builds the
monthly reporting marts, all with the DataFrame API.
"""

__version__ = "0.1.0"
