"""The corpus pipeline, stage by stage, against brute force."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from test_filters import brute_classes
from tokenizers import Tokenizer

from weatherlake.llm import toxicity
from weatherlake.llm.common import keep, table
from weatherlake.llm.mixing import mix
from weatherlake.llm.queries import VOCABULARY

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    names, columns = [], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = keep(stage(spark, docs, SF_DIR), name)
        after = docs.collect()
        names.append(name)
        if name != "bpe_codec":
            assert docs.columns == columns
            assert set(after) <= set(before)
        if name == "exact_dedup":
            best = {}
            for row in before:
                key = row.text.encode().lower()
                best[key] = max(best.get(key, row), row, key=lambda r: r.doc_id)
            assert Counter(after) == Counter(best.values())
        elif name == "near_dedup":
            least = {}
            for label, row in zip(brute_classes(before), before):
                least[label] = min(least.get(label, row), row, key=lambda r: r.doc_id)
            assert Counter(after) == Counter(least.values())
        elif name == "source_mix":
            copies = {r.doc_id: r.copies for r in mix(spark.createDataFrame(before, docs.schema)).collect()}
            assert Counter(r.doc_id for r in after) == Counter({i: n for i, n in copies.items() if n})
        elif name == "bpe_codec":
            library = Tokenizer.from_file(VOCABULARY)
            texts = {r.doc_id: r.text for r in before}
            assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before)
            for row in after:
                assert row.ids == library.encode(texts[row.doc_id], add_special_tokens=False).ids
    assert names == ["toxicity", "exact_dedup", "near_dedup", "source_mix", "bpe_codec"]


def test_toxicity_stage_follows_its_scores(spark):
    docs = table(spark, SF_DIR, "documents")
    net = toxicity.train(docs, table(spark, SF_DIR, "labels"))
    rejected = {r.doc_id for r in toxicity.score(docs, net).filter("rejected").collect()}
    kept = {r.doc_id for r in toxicity.clean(docs, net).collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()} - rejected


def test_odd_rows_pass_every_stage(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_DIR)
            assert out.count() <= 3 * docs.count()
            if name != "bpe_codec":
                assert out.columns == docs.columns
