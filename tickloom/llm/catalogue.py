"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import alignment, decontamination, language, media, mixing, ngram_join, scoring, secrets, token_counts, tokens, warc, whitening, wrapper

QUERIES = {"op7_wrapper": wrapper.op7_wrapper, "op9_ngram_join": ngram_join.op9_ngram_join, "op6_decontamination": decontamination.op6_decontamination, "op8_language": language.op8_language, "op1_flac": media.op1_flac, "op2_mixing": mixing.op2_mixing, "op3_secrets": secrets.op3_secrets, "op4_warc": warc.op4_warc, "op5_tokens": tokens.op5_tokens, "op10_lattice_score": scoring.op10_lattice_score, "op11_whitening": whitening.op11_whitening, "op12_token_counts": token_counts.op12_token_counts, "op13_alignment": alignment.op13_alignment}
ORACLES = decontamination.SQL | ngram_join.SQL | secrets.SQL | warc.SQL
