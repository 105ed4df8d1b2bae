"""Spark-native lakehouse toolkit for trade records."""
