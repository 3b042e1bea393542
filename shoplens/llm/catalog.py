"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from shoplens.llm import (
    crf_lines,
    gbt_html,
    lm_mix,
    mixing,
    orchard_codes,
    order_minhash,
    pattern_pack,
    piece_rounds,
    secret_owners,
    shift_merkle,
    syncmers,
    token_cache,
    warc,
)

QUERIES = {
    f.__name__: f
    for f in (
        lm_mix.op1_lm_mix,
        warc.op2_warc,
        order_minhash.op3_order_minhash,
        token_cache.op4_token_cache,
        mixing.op5_mixing,
        gbt_html.op6_gbt_html,
        crf_lines.op7_crf_lines,
        syncmers.op8_syncmers,
        pattern_pack.op9_pattern_pack,
        secret_owners.op10_secret_owners,
        orchard_codes.op11_orchard_codes,
        shift_merkle.op12_shift_merkle,
        piece_rounds.op13_piece_rounds,
    )
}
ORACLES: dict[str, str] = {
    "op5_mixing": mixing.OP5_SQL,
    "op11_orchard_codes": orchard_codes.OP11_SQL,
    "op12_shift_merkle": shift_merkle.OP12_SQL,
}
