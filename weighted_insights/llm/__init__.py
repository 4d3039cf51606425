"""Operators for building training corpora: personal data, quality, packing, tokens, duplicates, language models.

Every operator is a Spark job over the rows it is given; numpy works on bounded slices of texts
inside the tasks.  Nothing outside this package imports it.
"""
