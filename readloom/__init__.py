"""Single-cell read analytics as DataFrame plans."""
