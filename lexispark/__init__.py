"""Spark-first analytics over document corpora and the test sets made from them."""
