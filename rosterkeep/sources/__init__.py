"""Reading reports and exports, writing tables and reports."""
