"""Readers: files, tables and landed feeds."""
