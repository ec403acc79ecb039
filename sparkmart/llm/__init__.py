"""Operators for preparing training text: filters, deduplication, decontamination, token counts, packing and formatting."""
