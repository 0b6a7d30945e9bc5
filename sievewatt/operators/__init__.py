"""DataFrame to DataFrame operators; nothing in here reads or writes tables."""
