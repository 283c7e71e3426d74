"""Operators of a training-data pipeline; nothing else in the library imports this."""

from __future__ import annotations

from . import filter_audit, fingerprints, lexical, licenses, media, minhash, mixing, packing, quality, suffixes, token_store, urls, vectors

_MODULES = (licenses, quality, media, suffixes, token_store, mixing, vectors, packing, urls, minhash, fingerprints, filter_audit, lexical)

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
