"""lexloom: a Spark-native engine for building, repairing and auditing lexical data.

Sub-packages
------------
``sources``    readers (JSON lines, nested lexemes, wiki XML, packs, binary dictionaries, books)
``functions``  column expressions and Arrow text functions
``operators``  relational operators on DataFrames
``sinks``      dictionary writer, validator, reports
``plans``      composed pipelines, stage cache and the query catalogue
``streaming``  Structured Streaming variants
"""

__version__ = "0.1.0"
