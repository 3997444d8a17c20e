"""Writers: files, published tables, loads and event streams."""
