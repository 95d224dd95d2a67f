"""All queries of the subpackage and their oracle SQL."""

from tidepool.llm import bpe, classifier, decontaminate, html_extract, importance, license_scan, mixing, quality_rules, simhash, substring_dedup, url_filter, warc, whitening  # noqa: F401
from tidepool.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
