"""Watches, windows, purges and upserts on streams."""
