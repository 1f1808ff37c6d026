"""Reading inputs and writing reports, tables and logs."""
