"""Readers and writers: lake tables, raw JSON, Kafka, serving marts."""
