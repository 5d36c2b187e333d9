"""Queries of the operators on training text, and the SQL that checks them in DuckDB."""

import corpus_pipeline
from frostline.llm import (
    compression, decontaminate, licenses, masks, orchard, orderminhash, packing, passages, pieces, quality, sharding, urls, warc,
)

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_passages": passages.op2_passages,
    "op3_sharding": sharding.op3_sharding,
    "op4_licenses": licenses.op4_licenses,
    "op5_compression": compression.op5_compression,
    "op6_packing": packing.op6_packing,
    "op7_urls": urls.op7_urls,
    "op8_orderminhash": orderminhash.op8_orderminhash,
    "op9_quality": quality.op9_quality,
    "op10_warc": warc.op10_warc,
    "op11_pieces": pieces.op11_pieces,
    "op12_orchard": orchard.op12_orchard,
    "op13_masks": masks.op13_masks,
    "pipeline": corpus_pipeline.run,
}
CHECKS = {
    "op1_decontaminate": decontaminate.SQL,
    "op3_sharding": sharding.SQL,
    "op4_licenses": licenses.SQL,
    "op7_urls": urls.SQL,
    "op10_warc": warc.SQL,
    "op12_orchard": orchard.SQL,
    "op13_masks": masks.SQL,
}
