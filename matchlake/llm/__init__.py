"""Training-data pipeline operators (documents, pages and embeddings).

Every operator is a function from DataFrames to DataFrames with its own
general interface; :mod:`matchlake.llm.queries` holds the thin registered
queries.  Nothing outside this folder imports it.
"""
