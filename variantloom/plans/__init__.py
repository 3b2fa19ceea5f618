"""Registered queries and their oracles."""

from . import lifecycle, loci, results, sources  # noqa: F401  they register themselves
from .base import ORACLES, QUERIES
from .results import significant_snp_genes

__all__ = ["ORACLES", "QUERIES", "significant_snp_genes"]
