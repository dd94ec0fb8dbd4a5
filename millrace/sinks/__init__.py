from . import files, items, jdbc

__all__ = ["files", "items", "jdbc"]
