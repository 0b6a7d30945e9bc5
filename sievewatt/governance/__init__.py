"""Schema evolution and the audit log."""
