"""Importing this module registers every query of the package."""

from tidepanel.llm import conversation_repair, decontamination, langid, packing, pii, quality, reverse_search, secret_scan, sharding, simhash, substrings, topk, toxicity  # noqa: F401
from tidepanel.llm.common import QUERIES, SQL  # noqa: F401
