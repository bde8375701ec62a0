"""Registry of the numbered operators' queries and of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from wakeline.llm.bpe import op3_bpe
from wakeline.llm.centroids import OP13_SQL, op13_centroids
from wakeline.llm.collocations import OP12_SQL, op12_collocations
from wakeline.llm.language import op2_language
from wakeline.llm.mixing import OP11_SQL, op11_mixing
from wakeline.llm.ordermin import op10_ordermin
from wakeline.llm.packing import op1_packing
from wakeline.llm.pii import op4_pii
from wakeline.llm.quality import op6_quality
from wakeline.llm.sharding import op8_sharding
from wakeline.llm.simhash import op7_simhash
from wakeline.llm.substring import op5_substring
from wakeline.llm.warc import OP9_SQL, op9_warc

QUERIES: dict[str, Callable] = {
    "op1_packing": op1_packing,
    "op2_language": op2_language,
    "op3_bpe": op3_bpe,
    "op4_pii": op4_pii,
    "op5_substring": op5_substring,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_sharding": op8_sharding,
    "op9_warc": op9_warc,
    "op10_ordermin": op10_ordermin,
    "op11_mixing": op11_mixing,
    "op12_collocations": op12_collocations,
    "op13_centroids": op13_centroids,
}

ORACLES: dict[str, str] = {"op9_warc": OP9_SQL, "op11_mixing": OP11_SQL, "op12_collocations": OP12_SQL, "op13_centroids": OP13_SQL}
