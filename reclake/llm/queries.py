"""All corpus queries; importing this module registers them."""

from __future__ import annotations

from reclake.llm import decontaminate, grid_join, html_text, jaccard, language, lexical, line_dedup  # noqa: F401
from reclake.llm import pii, quality, substrings, tokenize, toxicity, whitening  # noqa: F401
from reclake.llm.registry import ORACLES, QUERIES  # noqa: F401
