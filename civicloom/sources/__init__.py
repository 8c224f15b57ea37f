from civicloom.sources import boundaries, files, payloads, relations

__all__ = ["boundaries", "files", "payloads", "relations"]
