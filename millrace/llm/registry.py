"""The queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from millrace.llm.bagminhash import bagminhash_query
from millrace.llm.divergence import divergence_query
from millrace.llm.fmindex import fmindex_query
from millrace.llm.mixing import ORACLE as MIXING_SQL, mixing_query
from millrace.llm.quotes import quotes_query
from millrace.llm.records import records_query
from millrace.llm.runs import runs_query
from millrace.llm.source_audit import ORACLE as SOURCE_AUDIT_SQL, source_audit_query
from millrace.llm.suffixes import suffixes_query
from millrace.llm.templates import ORACLE as TEMPLATES_SQL, templates_query
from millrace.llm.token_counts import token_counts_query
from millrace.llm.toxicity import toxicity_query
from millrace.llm.url_filter import url_filter_query

QUERIES = {
    "op1_records": records_query,
    "op2_divergence": divergence_query,
    "op3_token_counts": token_counts_query,
    "op4_bagminhash": bagminhash_query,
    "op5_templates": templates_query,
    "op6_suffixes": suffixes_query,
    "op7_quotes": quotes_query,
    "op8_mixing": mixing_query,
    "op9_fmindex": fmindex_query,
    "op10_toxicity": toxicity_query,
    "op11_source_audit": source_audit_query,
    "op12_url_filter": url_filter_query,
    "op13_runs": runs_query,
}

ORACLES: dict[str, str] = {
    "op5_templates": TEMPLATES_SQL,
    "op8_mixing": MIXING_SQL,
    "op11_source_audit": SOURCE_AUDIT_SQL,
}
