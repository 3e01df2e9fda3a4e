"""The pipeline against brute force, stage by stage."""

import collections
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tideguard.llm import decontamination, mixing, quality_classifier
from tideguard.llm.common import table
from tideguard.session import materialise

from test_llm_operators import SF, components


def test_stages(spark):
    docs, seen = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialise(stage(spark, before, SF), f"test-{name}")
        seen[name] = before, docs
        if name != "token_files":
            assert docs.columns == before.columns

    before, after = seen["quality_classifier"]
    net = quality_classifier.train(before, table(spark, SF, "labels"), quality_classifier.learn_from())
    good = {r[0] for r in quality_classifier.score(before, net).where("score >= 0.3").select("doc_id").collect()}
    assert {r[0] for r in after.select("doc_id").collect()} == good

    before, after = seen["minhash_near_dedup"]
    rows = [(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()]
    assert {r[0] for r in after.select("doc_id").collect()} == {c for _, c in components(rows, 5).values()}

    before, after = seen["benchmark_decontamination"]
    norm = lambda t: b" " + b" ".join(decontamination.words_of(t.encode())) + b" "
    items = [norm(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    clean = {r["doc_id"] for r in before.collect() if not any(q in norm(r["text"]) for q in items)}
    assert {r[0] for r in after.select("doc_id").collect()} == clean

    before, after = seen["source_mixing"]
    drawn = collections.Counter(r["doc_id"] for r in mixing.mix(before).collect())
    assert collections.Counter(r["doc_id"] for r in after.collect()) == drawn
    tokens = lambda df: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in df.collect())
    assert 0.97 * tokens(before) <= tokens(after) <= tokens(before)

    before, after = seen["token_files"]
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    want = sorted((r["doc_id"], len(ids := [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 2]),
                   zlib.crc32(np.array(ids, dtype="<u4").tobytes())) for r in before.collect())
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in after.collect())
    assert got == want
    starts = sorted((r["start"], r["n_tokens"]) for r in after.collect())
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
