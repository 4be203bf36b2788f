"""Writers for tables, exports and reports."""
