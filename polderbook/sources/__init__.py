"""Reading and keeping tapes and reference tables."""
