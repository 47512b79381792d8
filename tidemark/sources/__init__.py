"""Readers, type configuration, tables and exports."""
