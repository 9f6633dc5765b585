"""Column-level building blocks: pure ``Column -> Column`` functions."""
