"""All queries of this package."""

from chainfold.llm import cascade, chat, conversation_trie, digests, fill_middle, language, lattice, mixing, passages, simhash, templates, toxicity, warc  # noqa: F401
from chainfold.llm.common import QUERIES, SQL  # noqa: F401
