"""The queries of the corpus operators and the SQL that DuckDB can hold against them."""

from __future__ import annotations

from cairn.llm import bpe, collocations, decontaminate, importance, lm, media, neardup, permutation, quality, sharding, substrings, tokenfiles, toxicity

QUERIES = {
    "op1_ppm": lm.op1_ppm,
    "op2_bpe": bpe.op2_bpe,
    "op3_quality": quality.op3_quality,
    "op4_substrings": substrings.op4_substrings,
    "op5_tokenfiles": tokenfiles.op5_tokenfiles,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_sharding": sharding.op8_sharding,
    "op9_media": media.op9_media,
    "op10_neardup": neardup.op10_neardup,
    "op11_resample": importance.op11_resample,
    "op12_neighbours": permutation.op12_neighbours,
    "op13_collocations": collocations.op13_collocations,
}

SQL = {
    "op8_sharding": sharding.sql(),
    "op11_resample": importance.sql(),
    "op13_collocations": collocations.sql(),
}
