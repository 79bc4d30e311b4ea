"""Readers, writers, the model store and the generated-table mappings."""
