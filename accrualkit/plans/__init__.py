"""Report plans, their building blocks, and the named-query registry."""
