from . import catalog, files, generate, jdbc

__all__ = ["catalog", "files", "generate", "jdbc"]
