"""Sheets in, tables out."""
