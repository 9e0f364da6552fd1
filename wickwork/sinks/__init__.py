"""Writers of stored tables and staged files."""
