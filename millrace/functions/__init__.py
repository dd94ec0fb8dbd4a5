from . import predicates, scalar, text

__all__ = ["predicates", "scalar", "text"]
