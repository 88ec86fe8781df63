"""All queries of this subpackage; importing the modules registers them."""

from clickloom.llm import chat, decontamination, exact_dedup, language, merkle, near_duplicates, packing, sketches, substrings, suffix_tree, turn_trie, url_filter, warc
from clickloom.llm.queries import COMPARISONS, QUERIES

__all__ = ["COMPARISONS", "QUERIES", "chat", "decontamination", "exact_dedup", "language", "merkle", "near_duplicates", "packing", "sketches", "substrings", "suffix_tree", "turn_trie", "url_filter", "warc"]
