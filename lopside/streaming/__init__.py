"""The batch steps on streams."""
