import math
import re
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
from support import SF
from test_operators import plain_components, plain_fingerprint, plain_hits, plain_pieces, plain_repeats

from sigil.llm import quality_crf


def test_pipeline_against_plain_stages(spark, texts):
    found = corpus_pipeline.run(spark, SF).collect()
    model = quality_crf.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    ids = sorted(texts)
    left = {i: texts[i] for i, s in zip(ids, model.scores([texts[i] or "" for i in ids]), strict=True) if s >= 0.3}
    assert 0 < len(left) < len(texts)
    left = {i: t.decode() for i, _, _, t in plain_repeats(sorted(left.items()), 3, lambda t: t.encode().split(b"\n"), bytes.strip, b"\n")}
    same = plain_components(list(left), [plain_fingerprint(t) for t in left.values()])
    left = {i: t for i, t in left.items() if same[i] == i}
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    items = [(r.item_id, norm(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = {i: len(plain_hits(norm(t), items)[0]) for i, t in left.items()}
    left = {i: t for i, t in left.items() if not (hits[i] and 20 * hits[i] >= len(norm(t)))}
    want = plain_pieces(left)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found} == want
    sequences = defaultdict(int)
    for r in found:
        sequences[r.sequence_id] += r.length
    assert max(sequences.values()) <= 2048 and len(sequences) <= math.ceil(sum(x[1] for x in want.values()) / 2048) * 1.2 + 4


def test_stages_on_odd_tables(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            docs = out.checkpoint()
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert (last.count() > 0) == (docs.count() > 0)


def test_names():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert zlib.crc32(np.zeros(1, "<u4").tobytes()) > 0
