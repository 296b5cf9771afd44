"""Substring dedup against a table of all windows; blind tries and gram picks against plain sorting."""

import random

import numpy as np
import pytest
from basalt.llm import suffix_dedup
from basalt.llm.suffix_dedup import blind_tries, dedup_substrings, equal_windows, pick

SCHEMA = "doc_id long, text string, mark long, id string, size long, bucket int, digest string, content string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, 3, "d", "c") for i, t in rows], SCHEMA)


def brute(rows, length):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            if raw[p : p + length] in seen:
                gone[p : p + length] = True
            seen.add(raw[p : p + length])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
        out.append((i, len(raw), [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())], bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r[0], r.n_bytes, [tuple(x) for x in r.removed], bytes(r.kept)) for r in df.collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "of", "größer", "and", "running", "été", "x", "日本"]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    shared = [prose(30), prose(12), "License line that many documents carry, word for word."]
    rows = [(3, None), (4, ""), (5, "short"), (None, shared[0]), (90, "a" * 700), (91, "ab" * 300 + "a" * 200)]
    for i in range(100, 160):
        rows.append((i, " ".join(rng.choice([prose(rng.randrange(1, 25)), rng.choice(shared)]) for _ in range(rng.randrange(1, 5)))))
    rows += [(200 + k, rows[20][1]) for k in range(6)] + [rows[15], rows[15], (5, "short"), (6, "short")]
    for k in range(12):  # near copies
        t = list(rows[30 + k % 3][1] + prose(20))
        t[rng.randrange(len(t))] = "#"
        rows.append((300 + k, "".join(t)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("length, hot", [(100, 1000), (40, 1000), (40, 3), (10, 1000)])
def test_equals_table_of_windows(spark, monkeypatch, length, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = corpus(length)
    assert got(dedup_substrings(frame(spark, rows).repartition(5), length)) == brute(rows, length)


def test_long_text_in_pieces_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 100)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 2000)
    monkeypatch.setattr(suffix_dedup, "BATCH", 100)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 500)
    rows = corpus(1) + [(400, " ".join(t or "" for _, t in corpus(1)) * 2)]
    assert got(dedup_substrings(frame(spark, rows).repartition(3), 50)) == brute(rows, 50)


def test_empty_table(spark):
    out = dedup_substrings(frame(spark, []))
    assert out.columns == ["doc_id", "n_bytes", "removed", "kept"] and out.count() == 0


def test_blind_tries_sort():
    rng = np.random.default_rng(2)
    for alphabet in (2, 5):
        text = rng.integers(0, alphabet, 3000).astype(np.uint8)
        text[1000:1400] = text[200:600]
        padded = np.concatenate([text, np.zeros(48, np.uint8)])
        for m in (2, 5, 16):
            members = np.stack([rng.choice(2900, m, replace=False) for _ in range(40)])
            leaves, lcp = blind_tries(padded, members, 0, 40)
            for row, start, depth in zip(members, leaves, lcp):
                strings = [bytes(padded[s : s + 40]) for s in start]
                assert strings == sorted(bytes(padded[s : s + 40]) for s in row) and set(start) == set(row)
                for a, b, d in zip(strings, strings[1:], depth[1:]):
                    assert d == next((i for i in range(40) if a[i] != b[i]), 40)


def test_equal_windows_in_small_and_large_groups():
    rng = np.random.default_rng(4)
    parts = [rng.integers(0, 2, 60).astype(np.uint8) for _ in range(6)]
    text = np.concatenate([parts[i] for i in rng.integers(0, 6, 120)] + [np.zeros(64, np.uint8)])
    starts = np.arange(120 * 60 - 50)
    groups = (starts % 3).astype(np.uint64)
    at, of = equal_windows(text, starts, groups, 50)
    want = {}
    for s, g in zip(starts, groups):
        want.setdefault((g, bytes(text[s : s + 50])), set()).add(int(s))
    found = {}
    for a, c in zip(at, of):
        found.setdefault(int(c), set()).add(int(starts[a]))
    assert sorted(map(sorted, (x for x in found.values() if len(x) > 1))) == sorted(map(sorted, (x for x in want.values() if len(x) > 1)))


def test_equal_windows_pick_equal_grams():
    rng = np.random.default_rng(6)
    window = rng.integers(97, 101, 60).astype(np.uint8)
    picks = set()
    for _ in range(20):
        ahead = rng.integers(97, 101, rng.integers(0, 90)).astype(np.uint8)
        key, lead, first, count = pick(np.concatenate([ahead, window, rng.integers(97, 101, 30).astype(np.uint8)]), 60)
        run = np.searchsorted(first, len(ahead), side="right") - 1
        picks.add((int(key[run]), int(lead[run] - (len(ahead) - first[run]))))
        assert count.sum() == len(ahead) + 31
    assert len(picks) == 1
