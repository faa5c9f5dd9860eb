"""Training-data operators: thirteen corpus-scale jobs on documents, pages, conversations and embeddings.

Nothing else in the library imports this subpackage; ``queries`` lists what it registers.
"""
