"""Readers for messages, flow files and dimension files."""
