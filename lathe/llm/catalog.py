"""Imports every query module of this package so that the registry is complete."""

from lathe.llm import (  # noqa: F401
    hamming_index,
    lexical_search,
    license_scan,
    mixing,
    near_dedup,
    preferences,
    quality,
    recurrent_lm,
    sentence_pieces,
    sharding,
    token_counts,
    turn_repair,
    winnowing,
)
from lathe.llm.registry import ORACLES, QUERIES  # noqa: F401
