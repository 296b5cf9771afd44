"""Phrase collocations against plain counting, on awkward rows and with colliding fingerprints."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from basalt.llm import phrases
from basalt.llm.phrases import collocations, frequent_phrases

SCHEMA = "doc_id long, text string, lang string, print long, n long, key long, phrase string, rank int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, c, 1, 2, 3, "p", 4) for i, t, c in rows], SCHEMA)


def counts(rows, longest):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            f.update((lang or "und", tuple(words[i : i + m])) for m in range(1, longest + 1) for i in range(len(words) - m + 1))
    return f, n


def brute(rows, least, longest, top, inside=80):
    f, n = counts(rows, longest)
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    drop = set()
    for (lang, w), a in cand.items():
        for m in range(2, len(w)):
            drop |= {(lang, w[i : i + m]) for i in range(len(w) - m + 1) if 100 * a >= inside * f[lang, w[i : i + m]]}
    out = {}
    for (lang, w), a in cand.items():
        if (lang, w) not in drop:
            score, _, left, right = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for lang, xs in out.items() for r, (s, a, p, left, right) in enumerate(sorted(xs)[:top]))


def got(df):
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, size=150):
    rng = random.Random(seed)
    words = "The of OF and new York state élan Élan 東京 x-1 a b c d".split()
    shared = ["a b c d", "New York state of mind", "b\tc  d a", "of the of the of the"]
    end = [" ", ", ", ". ", "\n", "\x0b", "  ", "\t", "!? "]
    rows = [(1, None, "en"), (2, "", None), (3, " \n.,", "fr"), (None, "new york state " * 40, None), (5, "a " * 400, "en"), (5, "a " * 400, "en")]
    for i in range(size):
        text = "".join(rng.choice([rng.choice(words), rng.choice(shared)]) + rng.choice(end) for _ in range(rng.randrange(0, 60)))
        rows.append((i // 2, text, rng.choice(["en", "en", "fr", None, "und"])))
    return rows


@pytest.mark.parametrize("least, longest, top", [(30, 4, 2000), (8, 4, 7), (3, 3, 2000), (5, 2, 50)])
def test_equals_plain_counting(spark, least, longest, top):
    rows = corpus(least)
    want = brute(rows, least, longest, top)
    assert want
    assert got(collocations(frame(spark, rows).repartition(4), least, longest, top)) == want


def test_counts_of_parts_and_small_flushes(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HELD", 50)
    rows = corpus(7, 60)
    f, n = counts(rows, 4)
    want = sorted([(lang, len(w), " ".join(w), c) for (lang, w), c in f.items() if c >= 10] + [(lang, 0, "", c) for lang, c in n.items() if c])
    assert got(frequent_phrases(frame(spark, rows), 10)) == want


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    first = phrases.Words.prints
    # Only 7 distinct first fingerprints: nearly everything collides.
    monkeypatch.setattr(phrases.Words, "prints", lambda self, at, n, second=False: first(self, at, n, second) if second else first(self, at, n) % np.uint64(7))
    rows = corpus(9, 40)
    assert got(collocations(frame(spark, rows), 8)) == brute(rows, 8, 4, 2000)


def test_nothing_frequent(spark):
    for rows in ([], [(1, "a b", "en")], [(1, None, None)]):
        out = collocations(frame(spark, rows))
        assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and out.count() == 0
