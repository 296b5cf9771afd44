"""basalt: user-level data operators as Spark DataFrame functions.

Subpackages: ``sources`` (tables, delimited text), ``sinks`` (writers), ``functions``
(column expressions), ``operators`` (profiling, cleaning, relational, graph, clustering,
linear models, trees), ``plans`` (registered queries and join planning), ``streaming``.
"""

__version__ = "0.1.0"
