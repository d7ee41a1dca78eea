"""All queries of the training-data operators."""

from rivulet.llm import decontaminate, filteraudit, langid, merkle, mixing, pages, pieces, pii, quality, sharding, simhash, spelling, tokenids  # noqa: F401
from rivulet.llm.registry import ORACLES, QUERIES  # noqa: F401
