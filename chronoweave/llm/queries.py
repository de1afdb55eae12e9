"""Importing this module registers the queries of all operators."""

from chronoweave.llm import attention, chunks, dart, decontaminate, fim, html, language, lines, mixing, resample, secrets, suffixes, vectors  # noqa: F401
from chronoweave.llm.base import QUERIES, SQL  # noqa: F401
