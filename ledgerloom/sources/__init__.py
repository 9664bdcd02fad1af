"""Readers and writers: the table source, the data dictionary, model and metrics output."""
