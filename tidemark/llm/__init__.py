"""Training-data operators: one module per operator, registered by :mod:`tidemark.llm.registry`.

Nothing outside this subpackage imports it; deleting the folder leaves the rest of the library whole.
"""
