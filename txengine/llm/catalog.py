"""Query keys of the corpus operators and their SQL."""

from __future__ import annotations

from txengine.llm.bin_sketch import op5_bin_sketch
from txengine.llm.edit_pieces import op8_edit_pieces
from txengine.llm.euler_tour import OP13_SQL, op13_euler_tour
from txengine.llm.hashed_ftrl import op7_hashed_ftrl
from txengine.llm.language_ranks import op2_language_ranks
from txengine.llm.license_sentences import OP9_SQL, op9_license_sentences
from txengine.llm.log_bilinear import op4_log_bilinear
from txengine.llm.quality_votes import OP6_SQL, op6_quality_votes
from txengine.llm.shared_cuts import op11_shared_cuts
from txengine.llm.soft_mixing import op3_soft_mixing
from txengine.llm.super_kmers import OP12_SQL, op12_super_kmers
from txengine.llm.url_reputation import OP1_SQL, op1_url_reputation
from txengine.llm.zip_warc import OP10_SQL, op10_zip_warc

QUERIES = {
    "op1_url_reputation": op1_url_reputation,
    "op2_language_ranks": op2_language_ranks,
    "op3_soft_mixing": op3_soft_mixing,
    "op4_log_bilinear": op4_log_bilinear,
    "op5_bin_sketch": op5_bin_sketch,
    "op6_quality_votes": op6_quality_votes,
    "op7_hashed_ftrl": op7_hashed_ftrl,
    "op8_edit_pieces": op8_edit_pieces,
    "op9_license_sentences": op9_license_sentences,
    "op10_zip_warc": op10_zip_warc,
    "op11_shared_cuts": op11_shared_cuts,
    "op12_super_kmers": op12_super_kmers,
    "op13_euler_tour": op13_euler_tour,
}

SQL = {
    "op1_url_reputation": OP1_SQL,
    "op6_quality_votes": OP6_SQL,
    "op9_license_sentences": OP9_SQL,
    "op10_zip_warc": OP10_SQL,
    "op12_super_kmers": OP12_SQL,
    "op13_euler_tour": OP13_SQL,
}
