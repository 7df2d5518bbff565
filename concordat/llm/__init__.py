"""Training-data operators: duplicates, search, tokens, toxicity, private data, secrets and licences.

Nothing else in the library imports this subpackage. ``concordat.llm.queries`` registers one thin
query for each operator.
"""
