"""Operators of a training-data pipeline; nothing else in the package imports them."""

from . import (  # noqa: F401
    circulant,
    extract,
    language,
    lattice,
    mixing,
    multiset,
    neighbours,
    packing,
    prefix_trie,
    simhash,
    spelling,
    substrings,
    token_files,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
