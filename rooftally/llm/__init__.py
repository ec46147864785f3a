"""Training-data operators: filters, duplicate removal, packing, search and tokenisation over text and vector tables.

Each module holds one operator with a general interface over DataFrames; ``queries`` derives the registered
``opN_<name>`` queries from them. Nothing outside this subpackage and ``corpus_pipeline`` imports it.
"""
