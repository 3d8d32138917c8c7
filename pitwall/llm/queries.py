"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from pitwall.llm.bm25_leaks import op4_bm25_leaks
from pitwall.llm.dense_search import OP11_SQL, op11_dense_search
from pitwall.llm.huffman_file import op6_token_files
from pitwall.llm.ngram_join import OP10_SQL, op10_ngram_join
from pitwall.llm.pareto_mix import OP7_SQL, op7_pareto_mix
from pitwall.llm.private_spans import op12_private_spans
from pitwall.llm.quality_rank import op1_quality_rank
from pitwall.llm.scaled_sketch import op3_scaled_sketch
from pitwall.llm.secret_ledger import OP8_SQL, op8_secret_ledger
from pitwall.llm.separator_scan import op5_token_counts
from pitwall.llm.toxic_kernel import op2_toxic_kernel
from pitwall.llm.warc_audit import op9_warc_audit
from pitwall.llm.whitening import op13_whitening

QUERIES = {
    "op1_quality_rank": op1_quality_rank,
    "op2_toxic_kernel": op2_toxic_kernel,
    "op3_scaled_sketch": op3_scaled_sketch,
    "op4_bm25_leaks": op4_bm25_leaks,
    "op5_token_counts": op5_token_counts,
    "op6_token_files": op6_token_files,
    "op7_pareto_mix": op7_pareto_mix,
    "op8_secret_ledger": op8_secret_ledger,
    "op9_warc_audit": op9_warc_audit,
    "op10_ngram_join": op10_ngram_join,
    "op11_dense_search": op11_dense_search,
    "op12_private_spans": op12_private_spans,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL = {
    "op7_pareto_mix": OP7_SQL,
    "op8_secret_ledger": OP8_SQL,
    "op10_ngram_join": OP10_SQL,
    "op11_dense_search": OP11_SQL,
}
