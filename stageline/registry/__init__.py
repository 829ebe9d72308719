"""The registered queries, the control tables they run on, and their SQL twins."""
