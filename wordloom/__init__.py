"""wordloom: term indexes, ordered enrichment and batch top-k search on Spark.

The layers, from the inside out:

``functions``  column expressions (cleaning, tokens, labels, display text)
``operators``  DataFrame -> DataFrame steps (counts, postings, lists, top-k)
``sources``    readers and writers for delimited text and tables
``plans``      the whole jobs put together from the above
"""
