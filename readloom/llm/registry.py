"""The queries of this subpackage and, where SQL can express them, their SQL."""

from . import anchors, fim, media, mixing, neardup, packing, quality, resampling, search, secrets, suffixes, token_counts, toxicity

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_mixing": mixing.op3_mixing,
    "op4_suffixes": suffixes.op4_suffixes,
    "op5_packing": packing.op5_packing,
    "op6_neardup": neardup.op6_neardup,
    "op7_media": media.op7_media,
    "op8_secrets": secrets.op8_secrets,
    "op9_quality": quality.op9_quality,
    "op10_search": search.op10_search,
    "op11_substrings": anchors.op11_substrings,
    "op12_fim": fim.op12_fim,
    "op13_resampling": resampling.op13_resampling,
    "media_payloads": media.media_payloads,
}

ORACLE = {
    "op3_mixing": mixing.ORACLE,
    "op4_suffixes": suffixes.ORACLE,
    "op5_packing": packing.ORACLE,
    "op6_neardup": neardup.ORACLE,
    "op8_secrets": secrets.ORACLE,
    "media_payloads": media.PAYLOAD_SQL,
    "op10_search": search.ORACLE,
    "op11_substrings": anchors.ORACLE,
    "op12_fim": fim.ORACLE,
    "op13_resampling": resampling.ORACLE,
}
