"""Cell tables: where they come from, what they hold, and how results are stored."""
