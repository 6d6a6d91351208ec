"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from recolith.llm.op10_query import SQL as OP10_SQL
from recolith.llm.op10_query import op10_winnowing
from recolith.llm.op1_query import op1_sentencepiece
from recolith.llm.op2_query import SQL as OP2_SQL
from recolith.llm.op2_query import op2_line_dedup
from recolith.llm.op3_query import SQL as OP3_SQL
from recolith.llm.op3_query import op3_embedding_dedup
from recolith.llm.op4_query import op4_wavelet_matrix
from recolith.llm.op5_query import op5_weak_labels
from recolith.llm.op6_query import op6_histogram_sort
from recolith.llm.op7_query import SQL as OP7_SQL
from recolith.llm.op7_query import op7_stupid_backoff
from recolith.llm.op8_query import SQL as OP8_SQL
from recolith.llm.op8_query import op8_minhash_odd_sketch
from recolith.llm.op9_query import op9_pii

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_line_dedup": op2_line_dedup,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_wavelet_matrix": op4_wavelet_matrix,
    "op5_weak_labels": op5_weak_labels,
    "op6_histogram_sort": op6_histogram_sort,
    "op7_stupid_backoff": op7_stupid_backoff,
    "op8_minhash_odd_sketch": op8_minhash_odd_sketch,
    "op9_pii": op9_pii,
    "op10_winnowing": op10_winnowing,
}

ORACLES: dict[str, str] = {
    "op2_line_dedup": OP2_SQL,
    "op3_embedding_dedup": OP3_SQL,
    "op7_stupid_backoff": OP7_SQL,
    "op8_minhash_odd_sketch": OP8_SQL,
    "op10_winnowing": OP10_SQL,
}
