"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripcraft.llm.decontaminate import OP4_SQL, op4_decontaminate
from tripcraft.llm.embeddings import OP9_SQL, op9_embeddings
from tripcraft.llm.html import op3_html
from tripcraft.llm.kmeans import OP13_SQL, op13_clusters
from tripcraft.llm.langid import op10_langid
from tripcraft.llm.merkle import OP12_SQL, op12_merkle
from tripcraft.llm.mixing import OP7_SQL, op7_mixing
from tripcraft.llm.packing import op11_packing
from tripcraft.llm.pii import op6_pii
from tripcraft.llm.quality import op8_quality
from tripcraft.llm.simhash import op1_simhash
from tripcraft.llm.tokencount import op2_token_counts
from tripcraft.llm.tokens import op5_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_token_counts": op2_token_counts,
    "op3_html": op3_html,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_files": op5_token_files,
    "op6_pii": op6_pii,
    "op7_mixing": op7_mixing,
    "op8_quality": op8_quality,
    "op9_embeddings": op9_embeddings,
    "op10_langid": op10_langid,
    "op11_packing": op11_packing,
    "op12_merkle": op12_merkle,
    "op13_clusters": op13_clusters,
}

ORACLE: dict[str, str] = {
    "op4_decontaminate": OP4_SQL,
    "op7_mixing": OP7_SQL,
    "op9_embeddings": OP9_SQL,
    "op12_merkle": OP12_SQL,
    "op13_clusters": OP13_SQL,
}
