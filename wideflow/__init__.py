"""wideflow: invoice-table loads and wide-column cell tables on Spark DataFrames.

Everything here is expressed with built-in ``pyspark.sql.functions``, without a
Python UDF on any data path. Only the optional ``llm`` package, which nothing
else imports, runs Python in tasks (numpy and Arrow).
"""

__version__ = "0.1.0"
