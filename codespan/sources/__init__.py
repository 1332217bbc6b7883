"""Reading and writing projects and their parts."""
