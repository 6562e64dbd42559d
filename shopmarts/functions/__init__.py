"""Native column expressions (text, timestamps, month arithmetic, exact decimal ratios)."""
