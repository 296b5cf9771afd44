"""Vectorised text helpers, tokenisers and the perfect hash against plain versions."""

import hashlib
import inspect
import math
import random
import re
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from basalt.llm import arrowtext as A
from basalt.llm import exact_dedup, html_text, near_dedup, topk, toxicity
from basalt.llm.bpe import FAST_LIMIT, ByteBpe
from basalt.llm.sentencepieces import MARKER, Encoder
from tokenizers import Tokenizer

PIECES = ["'s", "'S", "'re", "'ll", "'l", "'", "  ", "\n", "\n\n", " ", "\t", "a", "bc", "12", "!?", "é", "ß", " ", "\u0085", "中", "''", "d", "\r\n", "٣", "😀", "<|endoftext|>", "▁"]


def texts(n, seed=3, most=12):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, most))) for _ in range(n)]


def each_slice(values, size=A.SLICE_BYTES):
    yield from A.slices(pa.record_batch({"text": pa.array(values, pa.string())}), "text", size)


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))


def bpe_ids(bpe, values, size=A.SLICE_BYTES):
    out = []
    for _, raw, offsets in each_slice(values, size):
        ids, n = bpe.encode(raw, offsets)
        out += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    return out


def test_slices_cover_all_rows_null_as_empty():
    values = ["a", None, "", "x" * 50, "b c"]
    got = [raw[a:b].tobytes().decode() for _, raw, o in each_slice(values, 10) for a, b in zip(o[:-1], o[1:])]
    assert got == ["a", "", "", "x" * 50, "b c"]


def test_slices_of_a_sliced_batch():
    batch = pa.record_batch({"text": pa.array(["ab", "cd", "ef", None])}).slice(1, 3)
    assert [raw.tobytes() for _, raw, _ in A.slices(batch, "text", 2)][:2] == [b"cd", b"ef"]
    assert b"".join(raw.tobytes() for _, raw, _ in A.slices(batch, "text")) == b"cdef"


def test_span_hashes_depend_on_content_only():
    raw = np.frombuffer(b"abc xx abc abd", np.uint8)
    s, e = A.runs(~A.WHITE[raw], np.array([0, len(raw)]))
    h = A.span_hashes(A.BYTE_VALUE[raw], s, e)
    assert h[0] == h[2] and len(set(h.tolist())) == 3


@pytest.mark.parametrize("size", [16, A.SLICE_BYTES])
def test_bpe_ids_equal_the_library(bpe, size):
    values = texts(3000)
    assert bpe_ids(bpe, values, size) == [bpe.tokenizer.encode(t, add_special_tokens=False).ids for t in values]


@pytest.mark.parametrize("size", [16, A.SLICE_BYTES])
def test_bpe_gives_added_tokens_their_id(bpe, size):
    fresh = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    values = ["hello <|endoftext|> world", "plain", "", "<|endoftext|>", "cut <|endof", "text|> apart", "a<|endoftext|><|endoftext|>b 中", "<|endoftext|", *texts(500, seed=8)]
    got = bpe_ids(bpe, values, size)
    assert got == [fresh.encode(t, add_special_tokens=False).ids for t in values]
    assert got[0] == [31373, 220, 50256, 995] and 50256 not in got[4] + got[5]


def test_bpe_classes_of_every_fast_code_point(bpe):
    values = [f"a{c}b1{c}2 {c}! {c}{c}x" for c in map(chr, range(1, FAST_LIMIT))]
    assert bpe_ids(bpe, values) == [bpe.tokenizer.encode(t, add_special_tokens=False).ids for t in values]


def plain_viterbi(enc, text):
    """Best segmentation of a whole text, one character at a time."""
    text = MARKER + text.replace(" ", MARKER) if text else ""
    index = {enc.pieces.surfaces[i]: int(i) for i in np.flatnonzero(enc.pieces.normal)}
    best = [(0.0, None, None)] + [None] * len(text)
    for p in range(len(text)):
        if best[p] is None:
            continue
        for q in range(p + 1, min(len(text), p + 16) + 1):
            i = index.get(text[p:q])
            score = enc.scores[i] if i is not None else enc.unknown_score if q == p + 1 else None
            if score is not None and (best[q] is None or best[p][0] + score > best[q][0]):
                best[q] = (best[p][0] + score, p, i)
    ids, at = [], len(text)
    while at:
        _, p, i = best[at]
        ids = ([i] if i is not None else [int(enc.pieces.byte_ids[b]) for b in text[p:at].encode()]) + ids
        at = p
    return ids


@pytest.fixture(scope="module")
def pieces():
    return Encoder(public_tokenizers.path("piece_bpe_32k.model"))


def test_sentencepiece_against_plain_viterbi_and_back(pieces):
    words = ["the", "ing", " ", "  ", "\n", "a", "é", "ß", "中", "日本", "😀", "x1", "tion", "\t", ".", "q", "łó"]
    rng = random.Random(5)
    values = ["".join(rng.choice(words) for _ in range(rng.randint(0, 14))) for _ in range(600)]
    for _, raw, offsets in each_slice(values, 200):
        ids, n = pieces.encode(raw, offsets)
        bounds = np.concatenate([[0], np.cumsum(n)])
        data, upto = pieces.decode(ids, bounds)
        for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            text = raw[a:b].tobytes().decode()
            assert ids[bounds[k] : bounds[k + 1]].tolist() == plain_viterbi(pieces, text)
            assert data[upto[k] : upto[k + 1]].tobytes().decode() == text


def test_sentencepiece_whole_text_mode_gives_the_same(pieces):
    values = ["the cat  sat\non the mat ", "", "a b c"]
    (_, raw, offsets), = each_slice(values)
    by_word = pieces.encode(raw, offsets)
    pieces.by_word = False
    try:
        pieces.cache.clear()
        whole = pieces.encode(raw, offsets)
    finally:
        pieces.by_word = True
        pieces.cache.clear()
    assert all(np.array_equal(x, y) for x, y in zip(by_word, whole))


def test_double_array_holds_every_piece(pieces):
    trie = pieces.trie
    for i in np.flatnonzero(pieces.pieces.normal)[::37].tolist():
        node = np.array([0])
        for byte in pieces.pieces.surfaces[i].encode():
            node = trie.step(node, np.array([byte]))
            assert node[0] >= 0
        assert trie.value[node[0]] == i


def test_perfect_hash_is_minimal_and_turns_nonmembers_away_by_bytes():
    words = exact_dedup._words(pa.array([hashlib.sha256(str(i).encode()).digest() for i in range(5000)]))
    levels, bits, slots = exact_dedup.build_perfect_hash(words)
    assert sorted(slots.tolist()) == list(range(5000))
    assert np.array_equal(exact_dedup.find_slots(words, levels, bits), slots)
    other = exact_dedup._words(pa.array([hashlib.sha256(f"x{i}".encode()).digest() for i in range(500)]))
    at = exact_dedup.find_slots(other, levels, bits)
    held = words[np.argsort(slots)]
    assert not any(s >= 0 and np.array_equal(held[s], o) for s, o in zip(at, other))
    assert exact_dedup.build_perfect_hash(words[:0])[0] == []
    with pytest.raises(ValueError):
        exact_dedup.build_perfect_hash(words[[0, 0]])


def plain_shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return set()
    return {tuple(words)} if len(words) < k else {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def test_shingle_sets_against_plain_sets():
    values = texts(400, seed=9, most=40) + ["", "one", "One two", "a b a b a b a", "x y z"]
    rows = [(raw, o) for _, raw, o in each_slice(values, 500)]
    sets = [set(s[a:b].tolist()) for raw, o in rows for s, bounds in [near_dedup.shingle_sets(raw, o, 3)] for a, b in zip(bounds[:-1], bounds[1:])]
    plain = [plain_shingles(t, 3) for t in values]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for i in range(0, len(values), 7):
        for j in range(i, len(values), 11):
            assert len(sets[i] & sets[j]) == len(plain[i] & plain[j])


def test_low_bits_estimate_similarity():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (850, 75, 75))
    values = np.concatenate([common, a, common, b])
    bits = near_dedup.low_bits(near_dedup.minima(values, np.array([0, 925, 1850]), 1024))
    x = bits[0] ^ bits[1]
    agree = 1024 - sum(bin(int((v | (v >> np.uint64(1))) & np.uint64(0x5555555555555555))).count("1") for v in x)
    assert abs((agree / 1024 - 0.25) / 0.75 - 0.85) < 0.06


def test_bit_counts_hardly_drop_a_pair_at_the_threshold():
    sigmas = inspect.signature(near_dedup.near_duplicates).parameters["sigmas"].default
    assert math.erfc(sigmas / math.sqrt(2)) / 2 < 2e-9


def read_clause(model, text):
    (_, raw, offsets), = each_slice([text])
    return toxicity.Reader(model).features(raw, offsets)[0]


def test_clause_grammar():
    model = toxicity.Model.from_seeds()
    plain = read_clause(model, "What an idiot. Fine day.")
    assert plain[0] == toxicity.SEED_WEIGHT and plain[2] == 1
    assert read_clause(model, "He is not an idiot.")[0] == pytest.approx(plain[0] * toxicity.NEGATED * toxicity.AIMED)
    assert read_clause(model, "Not today. An idiot!")[0] == plain[0]  # a negation ends with its clause
    assert read_clause(model, "She said an idiot wrote it")[0] < plain[0]
    assert read_clause(model, 'The sign read "idiot" there')[0] == pytest.approx(plain[0] * toxicity.REPORTED)
    assert read_clause(model, "They kill time")[2] == 0  # no target behind the threat
    assert read_clause(model, "We will kill you")[2] == 1
    assert read_clause(model, "")[2] == 0


@pytest.mark.parametrize("plain, negated, reported, aimed", [
    ("what an idiot", "he is not an idiot", "she said an idiot came", "you are an idiot"),
    ("so ein trottel", "er ist kein trottel", "angeblich kam ein trottel", "du bist ein trottel"),
    ("quel salaud", "ce n'est pas un salaud", "selon lui un salaud", "tu es un salaud"),
    ("qué asqueroso", "no es nunca asqueroso", "según ella asqueroso", "tú eres asqueroso"),
])
def test_a_clause_is_composed_in_four_languages(plain, negated, reported, aimed):
    model = toxicity.Model.from_seeds()
    scores = [float(toxicity.apply_logit(read_clause(model, f"Bla bla bla. {t} bla.")[None], model.logit)[0]) for t in (negated, reported, plain, aimed)]
    assert scores == sorted(scores) and len(set(scores)) == 4


def test_runs_give_all_their_matches_in_order():
    model = toxicity.Model({**toxicity.Model.from_seeds().patterns, "笨蛋": ("insult", 2.0), "不是": ("negation", 1.0)})
    assert read_clause(model, "we kill—you")[2] == 1  # a threat and its target, a dash between them
    assert read_clause(model, "kill…you")[2] == 0  # a sentence mark between them
    assert read_clause(model, "idiot—idiot")[toxicity.PLAIN] == 2 * toxicity.SEED_WEIGHT
    assert read_clause(model, "他真的是笨蛋")[toxicity.PLAIN] == 2.0  # no blanks: patterns begin at any letter
    assert read_clause(model, "他不是笨蛋")[toxicity.DENIED] == 2.0
    assert read_clause(model, "他不是。笨蛋")[toxicity.PLAIN] == 2.0  # a negation ends with its sentence


def test_contexts_of_insults_are_learned():
    counts = {"nix": (2, 60, 0, 0), "berichtet": (20, 20, 2, 60), "dein": (80, 1, 0, 0), "rare": (0, 4, 0, 0), "und": (50, 50, 30, 30)}
    got = toxicity.learn_contexts(counts, 100, 100)
    assert {k: v[0] for k, v in got.items()} == {"nix$": "negation", "berichtet$": "report", "dein$": "target"}
    assert toxicity.learn_contexts(counts, 0, 5) == {}


def test_patterns_cover_stems_and_whole_words():
    t = toxicity.Transducer({"lowe+": ("insult", 1.0), "idiot$": ("insult", 2.0), "mor": ("insult", 3.0)})
    assert t.read("lowe") is None and t.read("lower") == ("insult", 1.0)
    assert t.read("idiot") == ("insult", 2.0) and t.read("idiotic") is None
    assert t.read("moron") == ("insult", 3.0) and t.read("mo") is None


def test_learned_patterns_are_distinct_and_pure():
    counts = {"scu": (60, 0), "scum": (60, 0), "scum$": (60, 0), "scum+": (0, 0), "the": (90, 900), "wor": (40, 30), "worth": (40, 1), "rare": (3, 0)}
    got = toxicity.learn_patterns(counts, 100, 1000)
    assert set(got) == {"scum", "worth"} or set(got) == {"scum$", "worth"}
    assert toxicity.learn_patterns(counts, 0, 10) == {}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">a</a></li><li><a href="/b">b</a></li></ul></nav>
<!-- ad > --><div class="ad">Buy this thing now, it is a very good thing to buy.</div>
<div id="cookie-notice">We use cookies. Accept them all.</div>
<article><h1>Title</h1><p>First &amp; <b>bold&nbsp;text<br>with a
 break.<p>Second <a href="x">link</a> here, &lt;tag&gt;.</p><p>No.</p>
<aside>Related things</aside><form><p>Your mail <input name="m"></p></form>
<section class="comments"><p>A reader says that this article is long enough to look like content.</p></section></article>
<div class="sidebar"><p>Popular</p></div><footer>&copy; site</footer>"""


def test_html_main_text():
    tree = html_text.default_tree()
    assert html_text.main_text(PAGE, tree) == "Title\n\nFirst & bold text with a break.\n\nSecond link here, <tag>.\n\nNo."
    assert html_text.main_text(None, tree) == html_text.main_text("", tree) == html_text.main_text("<p></p><br>", tree) == ""
    assert html_text.main_text("<article><p>a</p><!-- open <p>b</p>", tree) == "a"
    assert html_text.main_text("<article><p>a</p><script>x < y", tree) == "a"
    long = " ".join(["word"] * 200_000)
    assert html_text.main_text(f"<body><div>{long}</div>", tree) == long


def test_html_hints_inside_other_names_keep_the_article():
    tree = html_text.default_tree()
    inner = "<p>One sentence of the text.</p><p>No.</p>"
    kept = "Title\n\nOne sentence of the text.\n\nNo."
    for page in (
        f'<article><header class="entry-header"><h1>Title</h1></header>{inner}</article>',
        f'<article><div class="post-header header"><h1>Title</h1></div>{inner}</article>',
        f'<div class="content-sidebar-wrap"><article><h1>Title</h1>{inner}</article></div>',
        f'<main class="content no-sidebar"><h1>Title</h1>{inner}</main>',
        f'<article class="post comments-open"><h1>Title</h1>{inner}</article>',
        f'<article class="related"><h1>Title</h1>{inner}</article>',
        f'<form id="form1"><div class="widget"><nav><a href="/">x</a></nav><article><h1>Title</h1>{inner}</article><div class="footer">Bye now</div></div></form>',
    ):
        assert html_text.main_text(f"<body>{page}</body>", tree) == kept, page


def test_html_words_overrule_a_hint_but_not_an_element():
    tree = html_text.default_tree()
    paragraphs = [" ".join([w] * n) for w, n in (("a", 120), ("b", 90), ("c", 150))]
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    assert html_text.main_text(f'<div class="widget"><h1>Title</h1>{body}</div>', tree) == "\n\n".join(["Title", *paragraphs])
    assert html_text.main_text(f"<aside><h1>Title</h1>{body}</aside>", tree) == ""
    for name in ("ad", "cookie-notice", "site-header", "sidebar-left", "comments-area", "google-ads", "shareButtons", "footerWidgets"):
        assert html_text.main_text(f'<div class="{name}"><p>Some words that no one came here for.</p></div><article><p>{paragraphs[0]}</p></article>', tree) == paragraphs[0], name


def test_html_comments_in_articles_of_their_own_are_left_out():
    page = '<article><p>The text itself.</p><section class="comments"><article><p>A reader says so.</p></article></section></article>'
    assert html_text.main_text(page, html_text.default_tree()) == "The text itself."


@pytest.mark.parametrize("page", [
    "<a '" * 100_000, "<a '" * 100_000 + "'>end", "<a \"'" * 80_000 + "> x", "<!" * 100_000, "<title>" * 60_000, "< " * 100_000 + "> x", "<a<b" * 100_000 + ">", "<!--" * 100_000,
    "<div>" * 40_000 + "</x>" * 40_000, "<div>" * 40_000 + "<p>x" * 40_000, "<b>" * 40_000 + "<p>x" * 40_000, "<p class='" * 60_000 + ">", "&#" + "9" * 200_000 + "; &#x" + "f" * 100_000, "</title " * 60_000,
    "<textarea>" + "</textarea " * 40_000, "<div class=ad>" * 30_000 + "x</div>" * 30_000, "<a href=x>" * 40_000 + "t",
])
def test_html_of_broken_long_pages_takes_linear_time(page):
    began = time.monotonic()
    html_text.main_text(page, html_text.default_tree())
    assert time.monotonic() - began < 6


def test_html_broken_quotes_end_a_tag_at_its_bracket():
    article = "<article><p>" + "word " * 40 + "</p><p title=\"it's>" + "other " * 40 + "</p></article>"
    assert html_text.main_text(article, html_text.default_tree()) == ("word " * 40).strip() + "\n\n" + ("other " * 40).strip()
    assert [b.text for b in html_text.blocks("<p>1 < 2 and <3 > 2</p><p>a <!-- b > c --> d <!-- e")] == ["1 < 2 and <3 > 2", "a d"]
    assert [b.text for b in html_text.blocks("<p>&#99999999999999999999; &#x110000; &amp;lt; &eacute;</p>")] == ["\ufffd \ufffd &lt; é"]


def test_html_teasers_beside_a_longer_article():
    teaser = "<article><h3><a href='/x'>Another story to read</a></h3><p>A line or two about the other story, no more than that.</p></article>"
    story = "<article><h1>The story itself</h1><p>" + "long text " * 60 + "</p><p>Short end.</p></article>"
    text = html_text.main_text(f"<body>{story}{teaser}{teaser}{teaser}</body>", html_text.default_tree())
    assert text == "The story itself\n\n" + ("long text " * 60).strip() + "\n\nShort end."


def test_html_deep_nesting_is_not_quadratic():
    page = '<div class="sidebar">' * 20_000 + "".join(f"<div>{i}</div>" for i in range(2_000))
    assert html_text.main_text(page, html_text.default_tree()) == ""


def test_tree_classifies_its_own_table():
    table = np.array(html_text.LABELLED)
    tree = html_text.default_tree()
    assert all(html_text.is_content(tree, row[:-1]) == bool(row[-1]) for row in table)


@pytest.mark.parametrize("spread", [3, 60, 5000])
def test_index_search_against_all_products(spread):
    rng = np.random.default_rng(spread)
    vectors = rng.integers(-spread, spread + 1, (700, 16))
    own = np.where(np.arange(60) < 40, np.arange(60), -1)  # the last 20 queries are no rows
    queries = np.concatenate([vectors[:40], rng.integers(-spread, spread + 1, (20, 16))])
    q, r, s = topk.Index(vectors).search(queries, own, 20)
    for i in range(60):
        scores = vectors @ queries[i]
        order = sorted((j for j in range(700) if j != own[i]), key=lambda j: (-scores[j], j))[:20]
        assert r[q == i].tolist() == order and s[q == i].tolist() == scores[order].tolist()


def test_search_leaves_postings_unread_once_it_has_proof():
    # Few high impacts, many low ones, as in term weights: the lists' tails cannot matter.
    rng = np.random.default_rng(1)
    vectors = np.where(rng.random((4096, 32)) < 0.02, rng.integers(2000, 4000, (4096, 32)), rng.integers(0, 40, (4096, 32)))
    queries = np.where(rng.random((50, 32)) < 0.2, rng.integers(1, 60, (50, 32)), 0)
    queries = queries[queries.any(axis=1)]
    index = topk.Index(vectors)
    q, r, s = index.search(queries, np.full(len(queries), -1), 10)
    assert index.read < 0.1 * 4096 * 32
    for i in range(len(queries)):
        scores = vectors @ queries[i]
        order = sorted(range(4096), key=lambda j: (-scores[j], j))[:10]
        assert r[q == i].tolist() == order and s[q == i].tolist() == scores[order].tolist()


def test_segments_hold_every_posting_once_in_order_of_impact():
    vectors = np.random.default_rng(2).integers(-90, 90, (300, 4))
    index = topk.Index(vectors)
    for which in range(8):
        impact = vectors[:, which] - index.low[which] if which < 4 else index.high[which - 4] - vectors[:, which - 4]
        seen = [(level, row) for level in range(index.top, -1, -1) for row in index.segment(which, level).tolist()]
        assert sorted(row for _, row in seen) == list(range(300))
        assert all(impact[row] // index.width == level for level, row in seen)
