"""Queries of the training-data operators and their SQL, by name."""

from . import bpe, convrepair, gridjoin, hardneg, licenses, linededup, minhash, mixing, pii, pll, simhash, toxicity, urlrules

_MODULES = (gridjoin, minhash, pll, mixing, pii, toxicity, licenses, bpe, simhash, linededup, urlrules, convrepair, hardneg)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
