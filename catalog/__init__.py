"""The registered queries on the provided tables, and the SQL that must give the same rows."""
