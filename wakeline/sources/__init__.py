"""Readers and writers: CSV archives, message topics, Parquet tables, JDBC tables, models."""
