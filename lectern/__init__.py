"""Lectern: a Spark-native engine for nested gazette documents, their grains, links, searches and reports."""
