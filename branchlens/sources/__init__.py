"""Reading landed JSON and day-partitioned tables; writing tables and reports."""
