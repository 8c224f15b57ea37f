from civicloom.functions import names, parse, semantics

__all__ = ["names", "parse", "semantics"]
