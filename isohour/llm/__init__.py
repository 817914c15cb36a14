"""Training-data operators over documents, pages, embeddings and conversations.

Nothing else in the library imports this package; ``queries`` holds its registered queries.
"""
