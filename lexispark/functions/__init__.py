"""Part of lexispark; see README.md."""
