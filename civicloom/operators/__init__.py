from civicloom.operators import geo, groups, joins, metrics, model, reshape

__all__ = ["geo", "groups", "joins", "metrics", "model", "reshape"]
