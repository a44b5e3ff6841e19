"""Reading and writing: timesheet files, business tables, summaries."""
