"""Reading and writing tables, the stored index, and the shared folder."""
