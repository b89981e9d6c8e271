"""File formats and message topics."""
