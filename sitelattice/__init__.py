"""Motif-site analytics on Spark: hit tables of many genetic lines to consolidated
motifs, features and models; and, in ``llm``, operators for training data."""
