"""Training-data operators: language, toxicity, duplicates, mixing, packing and more.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries when it is present.  Every operator takes and returns DataFrames;
Python code runs inside tasks over Arrow batches of bounded size.
"""
