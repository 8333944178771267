"""Registered queries of the numbered operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tramloom.llm import chat
from tramloom.llm.embedding_dedup import op9_embedding_dedup
from tramloom.llm.ffd_packing import op13_ffd_packing
from tramloom.llm.licenses import op7_licenses
from tramloom.llm.line_dedup import op4_line_dedup
from tramloom.llm.mixing import op2_mixing
from tramloom.llm.packing import op6_packing
from tramloom.llm.perplexity import op3_perplexity
from tramloom.llm.ranking import op12_ranking
from tramloom.llm.simhash import op5_simhash
from tramloom.llm.sketches import op10_fingerprints
from tramloom.llm.toxicity import op1_toxicity
from tramloom.llm.whitening import op11_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op3_perplexity": op3_perplexity,
    "op4_line_dedup": op4_line_dedup,
    "op5_simhash": op5_simhash,
    "op6_packing": op6_packing,
    "op7_licenses": op7_licenses,
    "op8_chat": chat.op8_chat,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_fingerprints": op10_fingerprints,
    "op11_whitening": op11_whitening,
    "op12_ranking": op12_ranking,
    "op13_ffd_packing": op13_ffd_packing,
}

#: Queries without a twin are beyond SQL; tests hold them against brute force.
ORACLE: dict[str, str] = {
    "op8_chat": chat.ORACLE,
}
