"""Spark-native evidence pipeline for tandem repeats in long reads."""
