"""Named queries over the retail roles, and the same queries as plain SQL."""
