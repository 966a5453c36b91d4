from . import exprs, lookups

__all__ = ["exprs", "lookups"]
