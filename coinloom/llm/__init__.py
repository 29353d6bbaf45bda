"""Training-data pipeline operators: ten Spark jobs over documents, pages and embeddings.

Nothing outside this subpackage imports it; `coinloom.llm.queries` holds the registered queries.
"""
