"""Sources: driver-table fixtures in the raw banking shapes, and file readers/writers."""
