"""The queries of this subpackage; importing the modules registers them."""

from . import bpe, conversation_trie, decontaminate, html_text, language, line_dedup, manifest, nearest, quality, secrets, sharding, simhash, warc  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
