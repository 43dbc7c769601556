import zlib

import numpy as np

import corpus_pipeline
from eventmart.llm import decontaminate, pii, tokens, toxicity
from eventmart.llm.common import table
from eventmart.llm.queries import tokenizer_path
from tests.llm.test_near_dedup import brute

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_stage_by_stage_brute_force(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    docs = table(spark, SF, "documents")
    lexicon = toxicity.fit(docs, table(spark, SF, "labels"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = [(d, t) for d, t in rows if lexicon.judge(t)[0] < 0.3]
    kept = {r[0] for r in brute(rows, corpus_pipeline.NEAR_PERCENT) if r[3]}
    items = list(decontaminate.item_chunks(table(spark, SF, "benchmark")))
    rows = [(d, t) for d, t in rows if d in kept and not any(i.search(t) for i in items)]
    tagger, want = pii.trained(), []
    for d, t in rows:
        base = pii.base_spans(t)
        clean = pii.masked(t, base + pii.added_spans(tagger, [t], [base])[0])
        ids = np.array([*tokens.encoder(tokenizer_path()).tokenizer.encode(clean, add_special_tokens=False).ids, 0], "<u4")
        want += [(d, k, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes()))
                 for k, at in enumerate(range(0, len(ids), 2048))]
    assert want and sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
