"""The query of lattice sampling returns the segmentations themselves."""

import zlib

import numpy as np
import public_tokenizers

from tidemark.llm.lattice_sampling import MARK, decode
from tidemark.llm.queries import QUERIES


def test_query_returns_the_pieces_of_every_whole_text(spark, sf_dir):
    docs = {r.doc_id: (r.text or "").replace(MARK, " ") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op6_lattice_sampling"](spark, sf_dir).cache()
    rows = found.collect()
    assert {r.doc_id for r in rows} == docs.keys()
    assert all(len(r.ids) == r.n_pieces and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    back = decode(found, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert len(back) == len(rows) and all(r.text == docs[r.doc_id] for r in back)
    assert len({(r.doc_id, *r.ids) for r in rows}) == len(rows)
