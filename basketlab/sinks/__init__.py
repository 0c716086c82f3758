"""Writers of tables and reports."""
