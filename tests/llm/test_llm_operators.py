"""Each operator on nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns with clashing names; near-duplicates and dedup against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from basalt.llm import langid, quality, toxicity
from basalt.llm.components import connected_components
from basalt.llm.exact_dedup import drop_exact_copies, exact_dedup
from basalt.llm.html_text import extract
from basalt.llm.near_dedup import drop_near_copies, near_duplicates
from basalt.llm.packing import pack
from basalt.llm.sentencepieces import encode_decode
from basalt.llm.tokenfiles import read_token_files, write_token_files
from basalt.llm.topk import top_k
from basalt.session import scratch_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, id string, n long, part string, base long, key string, label string, rep long, digest string"


def frame(spark, rows):
    """Rows (doc_id, text) with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", 7, "p", None, "k", "en", 3, "d") for i, t in rows], SCHEMA)


LONG = "long words and more " * 3000
EDGE = [(5, "Hello there, big world"), (1, None), (2, ""), (3, LONG), (4, " \n\t "), (5, "Hello there, big world"), (None, "no id here at all"), (9, "Ünïcode 日本 😀")]


@pytest.fixture(scope="module")
def edge(spark):
    return frame(spark, EDGE)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def ids_of(text, end):
    return Tokenizer.from_file(BPE).encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_packing(edge, empty):
    rows = pack(edge, BPE, window=64).collect()
    total = sum(len(ids_of(t, 0)) for _, t in EDGE)
    assert sum(r.length for r in rows) == total
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    assert sorted(by_sequence) == list(range(-(-total // 64)))
    for s, pieces in by_sequence.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 64 or s == max(by_sequence)
    for i, t in EDGE:
        ids = ids_of(t, 0)
        mine = sorted((r for r in rows if r.doc_id == i and r.doc_tokens == len(ids)), key=lambda r: (r.start, r.sequence_id))
        assert {r.ids_crc32 for r in mine if r.start == 0} == {crc(ids[: r.length]) for r in mine if r.start == 0}
        assert all(r.ids_crc32 == crc(ids[r.start : r.start + r.length]) for r in mine)
    assert pack(empty, BPE).count() == 0


def test_token_files(spark, edge, empty):
    folder = scratch_path(spark, "test-tokens")
    write_token_files(edge, folder, BPE, end_id=2, partitions=3)
    rows = read_token_files(spark, folder, edge.schema["doc_id"].dataType, with_ids=True).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 5, 9]
    at, text = 0, dict(EDGE)
    for r in rows:
        want = ids_of(text[r.doc_id], 2)
        assert (r.start, r.n_tokens, r.ids_crc32, r.ids) == (at, len(want), crc(want), want)
        at += len(want)
    folder = scratch_path(spark, "test-tokens")
    write_token_files(empty, folder, BPE, end_id=2)
    assert read_token_files(spark, folder, edge.schema["doc_id"].dataType).count() == 0


def test_sentencepiece(edge, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = encode_decode(edge, path).collect()
    assert len(rows) == len(EDGE) and all(r.round_trip for r in rows)
    assert {r.n_pieces for r in rows if r.doc_id in (1, 2)} == {0}
    assert encode_decode(empty, path).count() == 0


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_dedup(spark, edge, empty):
    rows = [*EDGE, (11, "a b c"), (10, "abc"), (12, "a  b c"), (13, "ab c"), (8, "a  b c")]
    for historical in (None, F.col("doc_id") < 6, F.lit(False), F.lit(True)):
        got = exact_dedup(frame(spark, rows), historical, part_digests=2).collect()
        assert len(got) == len(rows)
        by = {(r.doc_id, r.text_sha256): r for r in got}
        groups = defaultdict(list)
        for i, t in rows:
            groups[hashlib.sha256(bare(t).encode()).hexdigest()].append((-len(t or ""), i is None, i or 0, i))
        for digest, members in groups.items():
            keep = min(members)[3]
            for m in members:
                r = by[m[3], digest]
                assert (r.keep_id, r.group_size) == (keep, len(members))
            assert sum(r.kept for r in got if r.text_sha256 == digest) == 1
    assert exact_dedup(empty).count() == 0


def test_drop_exact_copies_keeps_columns_and_one_row(spark, empty):
    rows = [*EDGE, (11, "a b c"), (12, "a  b c"), (8, "a  b c")]
    kept = drop_exact_copies(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1 if False else 4, 3, 5, None, 9, 8], key=str)
    assert drop_exact_copies(empty).count() == 0


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words)} if len(words) < k else {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def plain_components(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    smallest = {i: i for i, _ in sets}

    def root(x):
        while smallest[x] != x:
            x = smallest[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                i, j = sorted((root(i), root(j)))
                smallest[j] = i
    return {i: (len(s), root(i)) for i, s in sets}


def corpus(seed, families=12, size=14):
    """Families of texts at many distances from each other, copies, and texts apart."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, i = [], 100
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([2, 4, 30, 80, 200]))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((i, " ".join(words)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, k, percent):
    rows = corpus(k) + [(1, None), (2, ""), (3, "one"), (4, "One"), (7, "one  two"), (8, LONG), (9, LONG + "end")]
    got = near_duplicates(frame(spark, rows), words=k, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(rows, k, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_edge_rows(spark, edge, empty):
    got = near_duplicates(edge, words=3, percent=85).collect()
    assert len(got) == len(EDGE)
    alone = [r for r in got if r.doc_id is None]
    assert len(alone) == 1 and alone[0].component_id is None and alone[0].kept
    assert near_duplicates(empty).count() == 0
    kept = drop_near_copies(edge)
    assert kept.columns == edge.columns and kept.count() == len(EDGE)  # rows that share an id stay together


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(5, 5)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    smallest = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(smallest[a], smallest[b])
            if (smallest[a], smallest[b]) != (low, low):
                smallest[a] = smallest[b] = low
                changed = True
    assert got == {x: c for x, c in smallest.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_components_of_small_shapes(spark):
    for edges, want in (([(5, 1), (5, 2)], {1: 1, 2: 1, 5: 1}), ([], {}), ([(7, 7)], {}), ([(1, 2), (2, 3), (3, 4), (9, 8)], {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8})):
        assert {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()} == want


def labels_of(spark, pairs):
    return spark.createDataFrame(pairs, "id long, label int")


def toxic_corpus(n=240):
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "lower", "lowly"]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                text[rng.randrange(30)] = "zork" + rng.choice(["el", "um", "a", "ist"])
        rows.append((i, " ".join(text) + "."))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_learns_stems_and_scores_all_rows(spark, edge, empty):
    rows, labels = toxic_corpus()
    model = toxicity.fit(frame(spark, rows), labels_of(spark, [x for x in labels if x[0] % 3]))
    assert any(p.startswith("zork") for p in model.patterns)
    got = {r.doc_id: r for r in toxicity.score(frame(spark, rows), model).collect()}
    assert all(got[i].predicted == y for i, y in labels)
    assert toxicity.score(edge, model).filter("score >= 0 and score <= 1 and predicted = 0").count() == len(EDGE)
    assert toxicity.score(empty, model).count() == 0
    kept = toxicity.drop_toxic(frame(spark, rows), model)
    assert kept.columns == edge.columns and kept.count() == sum(1 - y for _, y in labels)


def test_toxicity_learns_negations_before_learned_insults(spark):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(12)]
        if i % 3 == 0:
            text[6] = "zorkel"
        if i % 9 == 0:
            text[5] = "nixo"  # and the insult behind it is no insult
        rows.append((i, " ".join(text) + "."))
        labels.append((i, int(i % 3 == 0 and i % 9 != 0)))
    model = toxicity.fit(frame(spark, rows), labels_of(spark, labels))
    assert model.patterns["nixo$"] == ("negation", 1.0)
    got = {r.doc_id: r.score for r in toxicity.score(frame(spark, [(1, "alpha beta zorkel gamma"), (2, "alpha nixo zorkel gamma"), (3, "alpha beta")]), model).collect()}
    assert got[1] > 0.5 > got[2] and got[3] < 0.5


def test_toxicity_without_labels_uses_the_lists(spark, edge, empty):
    model = toxicity.fit(empty, labels_of(spark, []))
    assert model.patterns == toxicity.Model.from_seeds().patterns
    assert toxicity.score(edge, model).count() == len(EDGE)


def test_quality_learns_junk(spark, edge, empty):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows, labels = [], []
    for i in range(200):
        text = [rng.choice(words) for _ in range(40)]
        junk = i % 3 == 0
        rows.append((i, " ".join(f"{w}%%%" if junk else w for w in text) + "."))
        labels.append((i, int(not junk)))
    model = quality.fit(frame(spark, rows), labels_of(spark, [x for x in labels if x[0] % 4]))
    got = {r.doc_id: r.predicted for r in quality.score(frame(spark, rows), model).collect()}
    assert all(got[i] == y for i, y in labels)
    assert np.count_nonzero(model.weights) < 500  # the L1 term keeps the weights sparse
    assert quality.score(edge, model).filter("score >= 0 and score <= 1").count() == len(EDGE)
    assert quality.score(empty, model).count() == 0
    assert quality.score(edge, quality.fit(empty, labels_of(spark, []))).filter("score = 0.5").count() == len(EDGE)


def test_language_identification(spark, edge, empty):
    rng = random.Random(6)
    syllables = {"xa": ["ba", "lo", "mi", "tu"], "yb": ["sch", "ung", "ein", "pf"], "zc": ["é", "eau", "oui", "ç"]}
    rows = [(i, lang, " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(20))) for i, lang in enumerate(list(syllables) * 60)]
    docs = frame(spark, [(i, t) for i, _, t in rows])
    known = spark.createDataFrame([(i, lang if i % 10 else None) for i, lang, _ in rows if i % 4 != 2], "id long, label string")
    model = langid.fit(docs, known)
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert all(got[i].lang_pred == lang and not got[i].rejected for i, lang, _ in rows)
    odd = {r.doc_id: r for r in langid.identify(frame(spark, [(1, None), (2, ""), (3, "12 34!"), (4, "–— …"), (5, "é")]), model).collect()}
    assert [odd[i].lang_pred for i in (1, 2, 3, 4)] == ["und"] * 4 and odd[5].lang_pred == "zc"
    assert all(odd[i].rejected and odd[i].score == 0 for i in (1, 2, 3, 4))
    assert langid.identify(edge, model).count() == len(EDGE) and langid.identify(empty, model).count() == 0
    assert langid.drop_unidentified(docs, model).count() == len(rows)
    assert langid.identify(edge, langid.fit(empty, known.limit(0))).filter("lang_pred = 'und'").count() == len(EDGE)


def test_text_of_an_unlearned_language_is_rejected(spark):
    rng = random.Random(16)
    words = {k: ["".join(rng.choice(s) for _ in range(3)) for _ in range(300)] for k, s in {"xa": ["ba", "lo", "mi", "tu", "re"], "yb": ["sch", "ung", "ein", "pf", "ke"], "new": ["szcz", "owi", "dzi", "ły", "kre"]}.items()}

    def text(lang, n):
        return " ".join(rng.choice(words[lang]) for _ in range(n))

    learned = [(i, ("xa", "yb")[i % 2], text(("xa", "yb")[i % 2], 120 if i % 3 else 12)) for i in range(3000)]
    model = langid.fit(frame(spark, [(i, t) for i, _, t in learned[:2600]]), spark.createDataFrame([(i, k) for i, k, _ in learned[:2600]], "id long, label string"))
    unlearned = [(10_000 + i, text("new", 120 if i % 3 else 12)) for i in range(300)]
    found = {r.doc_id: r.rejected for r in langid.identify(frame(spark, [(i, t) for i, _, t in learned[2600:]] + unlearned), model).collect()}
    assert sum(found[i] for i, _, _ in learned[2600:]) <= 8  # 0.2% is meant, over 400 rows
    assert sum(found[i] for i, _ in unlearned) >= 290


def test_lowest_probability_kept():
    p = np.linspace(0.5, 1, 1001)
    assert langid.lowest_kept(p, 0.998, 4) == pytest.approx(0.501)
    assert langid.lowest_kept(np.array([0.9, 0.99]), 0.998, 4) == pytest.approx(0.634, abs=1e-3)
    assert langid.lowest_kept(p[:0], 0.998, 4) == langid.lowest_kept(p, 0.998, 1) == 0


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (2, None, "<article><p>a&amp;b <i>c</i></article>", "x"), (None, "u", "<nav>x</nav>", "x")], "page_id long, url string, html string, text string")
    assert sorted((r.text, r.n_chars) for r in extract(pages).collect()) == [("", 0), ("", 0), ("", 0), ("a&b c", 5)]
    assert extract(pages.limit(0)).count() == 0


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 1) for i in range(150)]
    rows += [(500 + i, rows[3][1], 1) for i in range(30)]  # ties
    rows += [(700, None, 1), (720, [], 1), (740, [1.0, None] + [0.0] * 6, 1), (760, [float("nan")] * 8, 1), (780, [float("inf")] * 8, 1), (None, [1.0] * 8, 1)]
    rows += [(800, [1.0, 2.0], 1), (801, [3.0, -1.0], 1)]  # another dimension
    rows += [(60, rows[60][1], 1), (61, rows[61][1], 1), (60, rows[5][1], 1)]  # repeated ids
    frame_ = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = defaultdict(list)
    for r in top_k(frame_, F.col("vec_id") % 20 == 0, k=20, index_rows=40, query_rows=5).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    valid = [(i, np.floor(64 * np.array(v, float)).astype(int)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all()]
    want = defaultdict(list)
    for a, (q, w) in enumerate(valid):
        if q % 20 == 0:
            scores = sorted((-int(w @ v), i) for b, (i, v) in enumerate(valid) if b != a and len(v) == len(w))[:20]
            want[q] += [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert {q: sorted(x) for q, x in got.items()} == {q: sorted(x) for q, x in want.items()}
    assert top_k(frame_.limit(0), F.col("vec_id") % 20 == 0).count() == 0
