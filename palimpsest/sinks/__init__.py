"""Outputs: CSV tables, XML documents, and a dry run that writes nothing."""
