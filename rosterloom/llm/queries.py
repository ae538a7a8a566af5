"""The training-text operators as queries over whole tables."""

from __future__ import annotations

from rosterloom.llm import (decontaminate, licenses, merkle, negatives, nndescent, packing, pii,
                            quality, secrets, sharding, simhash, urls, warc)

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_sharding": sharding.op2_sharding,
    "op3_nndescent": nndescent.op3_nndescent,
    "op4_pii": pii.op4_pii,
    "op5_licenses": licenses.op5_licenses,
    "op6_secrets": secrets.op6_secrets,
    "op7_warc": warc.op7_warc,
    "op8_packing": packing.op8_packing,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_quality": quality.op10_quality,
    "op11_negatives": negatives.op11_negatives,
    "op12_merkle": merkle.op12_merkle,
    "op13_urls": urls.op13_urls,
}

#: The others have no SQL form; tests/llm compares them with brute-force versions.
ORACLES: dict[str, str] = {
    "op11_negatives": negatives.ORACLE,
    "op12_merkle": merkle.ORACLE,
    "op13_urls": urls.oracle(),
}
