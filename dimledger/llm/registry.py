"""Queries and oracle SQL of the training-data operators."""

from importlib import import_module

MODULES = ("minhash", "licenses", "quality", "decontaminate", "curriculum", "chat", "huffman",
           "html_layout", "pii", "toxicity", "neighbours", "alignment", "repair")

QUERIES: dict = {}
ORACLE: dict = {}
for _name in MODULES:
    _module = import_module(f"dimledger.llm.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)
