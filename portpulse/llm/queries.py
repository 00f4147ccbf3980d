"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from portpulse.llm.bpe import op7_bpe
from portpulse.llm.embedding_dedup import op9_embedding_dedup
from portpulse.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from portpulse.llm.filter_audit import OP12_SQL, op12_filter_audit
from portpulse.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from portpulse.llm.mixing import OP13_SQL, op13_source_mix
from portpulse.llm.ngram_join import op8_ngram_join
from portpulse.llm.packing import op2_packing
from portpulse.llm.quality import op3_quality
from portpulse.llm.substring_dedup import op4_substring_dedup
from portpulse.llm.toxicity import op10_toxicity
from portpulse.llm.url_filter import OP1_SQL, op1_url_filter
from portpulse.llm.warc import OP6_SQL, op6_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_url_filter,
        op2_packing,
        op3_quality,
        op4_substring_dedup,
        op5_exact_dedup,
        op6_warc,
        op7_bpe,
        op8_ngram_join,
        op9_embedding_dedup,
        op10_toxicity,
        op11_hard_negatives,
        op12_filter_audit,
        op13_source_mix,
    )
}
ORACLE: dict[str, str] = {
    "op1_url_filter": OP1_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op6_warc": OP6_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_source_mix": OP13_SQL,
}
