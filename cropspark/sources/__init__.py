"""Reading landed files and writing snapshots, lakes and tables."""
