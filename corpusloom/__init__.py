"""corpusloom: a Spark-native engine for building language-model corpora.

Scalars are ``Column -> Column`` functions, relational steps are
``DataFrame -> DataFrame`` functions, and order is always carried by an explicit
key column because a DataFrame has none.
"""

__version__ = "0.1.0"
