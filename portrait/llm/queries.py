"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from portrait.llm.bpe import op1_bpe
from portrait.llm.convrepair import op12_convrepair
from portrait.llm.decontaminate import op4_decontaminate
from portrait.llm.htmltext import op5_htmltext
from portrait.llm.licenses import OP10_SQL, op10_licenses
from portrait.llm.linededup import OP7_SQL, op7_linededup
from portrait.llm.pii import op9_pii
from portrait.llm.quality import op6_quality
from portrait.llm.sharding import op8_sharding
from portrait.llm.simhash import op3_simhash
from portrait.llm.suffixdedup import op11_suffixdedup
from portrait.llm.tokenalign import op13_tokenalign
from portrait.llm.urlgraph import OP2_SQL, op2_urlgraph

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_urlgraph": op2_urlgraph,
    "op3_simhash": op3_simhash,
    "op4_decontaminate": op4_decontaminate,
    "op5_htmltext": op5_htmltext,
    "op6_quality": op6_quality,
    "op7_linededup": op7_linededup,
    "op8_sharding": op8_sharding,
    "op9_pii": op9_pii,
    "op10_licenses": op10_licenses,
    "op11_suffixdedup": op11_suffixdedup,
    "op12_convrepair": op12_convrepair,
    "op13_tokenalign": op13_tokenalign,
}

SQL: dict[str, str] = {
    "op2_urlgraph": OP2_SQL,
    "op7_linededup": OP7_SQL,
    "op10_licenses": OP10_SQL,
}
