"""lexloom: a PySpark-native engine for dictionary-like and other semi-structured text corpora."""
