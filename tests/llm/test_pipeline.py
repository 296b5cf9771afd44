"""Each pipeline stage against a brute-force version of itself, on what its predecessor kept."""

import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from basalt.llm import arrowtext, langid, toxicity
from basalt.llm.queries import language_model, toxicity_model
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def one(text):
    """A single text as a flat slice."""
    (_, raw, offsets), = arrowtext.slices(pa.record_batch({"text": pa.array([text], pa.string())}), "text")
    return raw, offsets


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(90_001, None, "en", "x", 0), (90_002, "", None, "x", 0), (90_003, "12 34", "en", "x", 5), (90_003, "12 34", "en", "x", 5)]
    return docs.unionByName(spark.createDataFrame(odd, docs.schema))


def test_toxic_documents_go(spark):
    docs = documents(spark)
    model = toxicity_model(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = STAGES["toxicity"](spark, docs, SF)
    assert kept.schema == docs.schema
    reader = toxicity.Reader(model)
    assert ids(kept) == sorted(r.doc_id for r in docs.collect() if toxicity.apply_logit(reader.features(*one(r.text)), model.logit)[0] < 0.5)


def test_unidentified_documents_go(spark):
    docs = documents(spark)
    model = language_model(docs)
    kept = ids(STAGES["language id"](spark, docs, SF))
    want = []
    for r in docs.collect():
        raw, offsets = one(r.text)
        # The logits of every subword, added up one by one.
        h, _ = langid.subwords(raw, offsets)
        if any(c.isalpha() for c in r.text or ""):
            z = (sum(model.logits[:, i].astype(float) for i in h) / max(1, len(h)) + model.bias) / model.temperature
            p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
            size = sum(len((r.text or "").encode()) > n for n in langid.PIECE_LIMITS)
            if p.max() >= model.lowest[size] - 1e-9:
                want.append(r.doc_id)
    assert kept == sorted(want) and not {90_001, 90_002, 90_003} & set(kept)


def test_one_of_equal_texts_stays(spark):
    docs = documents(spark)
    groups = defaultdict(list)
    for r in docs.collect():
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append((-len(r.text or ""), r.doc_id))
    assert ids(STAGES["exact dedup"](spark, docs, SF)) == sorted(min(g)[1] for g in groups.values())


def test_one_of_near_copies_stays(spark):
    docs = documents(spark).dropDuplicates(["doc_id"])
    sets = {}
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in r.text or ""))
        sets[r.doc_id] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    assert ids(STAGES["near dedup"](spark, docs, SF)) == sorted(i for i in sets if find(i) == i)


def test_packed_pieces_hold_every_id_once(spark):
    docs = documents(spark).dropDuplicates(["doc_id"])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    length = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect()}
    pieces = defaultdict(list)
    places = set()
    for r in STAGES["packing"](spark, docs, SF).collect():
        pieces[r.doc_id].append((r.start, r.length))
        assert r.doc_tokens == length[r.doc_id] and r.offset + r.length <= 1024
        taken = {(r.sequence_id, r.offset + i) for i in range(r.length)}
        assert not taken & places
        places |= taken
    for i, n in length.items():
        at = 0
        for start, size in sorted(pieces[i]):
            assert start == at
            at += size
        assert at == n


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF)
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    want = sorted(map(tuple, docs.select("doc_id", "start", "length", "ids_crc32").collect()))
    got = corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == want
    assert got.agg(F.count_distinct("doc_id")).first()[0] < 200
