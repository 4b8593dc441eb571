"""Readers: feed lists, the registry, feed documents, stored objects, exports."""
