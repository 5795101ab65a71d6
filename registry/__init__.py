"""Queries over the given tables, each with the SQL that an independent engine checks it with."""

from __future__ import annotations

from . import acquire, alerts, bias, preprocess, profile, training, validate

_PARTS = (acquire, preprocess, validate, profile, bias, training, alerts)


def _merged(attribute: str) -> dict:
    out: dict = {}
    for part in _PARTS:
        for name, entry in getattr(part, attribute).items():
            if name in out:
                raise ValueError(f"query {name} is registered twice")
            out[name] = entry
    return out


QUERIES = _merged("QUERIES")
ORACLE = _merged("ORACLE")
# Query name -> identifiers of the operator inventory it exercises.
COVERAGE = _merged("COVERS")
