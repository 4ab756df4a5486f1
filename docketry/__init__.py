"""docketry: document-corpus analytics as PySpark DataFrame operators.

``functions``  column expressions and Arrow UDFs over text, names, citations, dates, urls
``operators``  relational operators: histories, references, identity, dedupe, graph, quality
``sources``    readers and sinks
``plans``      the registered queries with their reference SQL
``streaming``  Structured Streaming forms of the stateful operators
``llm``        optional operators for training-data pipelines; nothing above imports it
"""
