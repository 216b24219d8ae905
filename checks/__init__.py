"""The queries that the entry file registers, and the SQL they are compared with."""
