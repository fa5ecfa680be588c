"""tidemark: port-call analytics over vessel position messages, as Spark DataFrame plans.

Raw messages become stop events, stop events become traffic cells, hot cells
become port clusters, and clusters are enriched, identified and exported.  Every
operator is a ``DataFrame -> DataFrame`` function.
"""

__version__ = "0.1.0"
