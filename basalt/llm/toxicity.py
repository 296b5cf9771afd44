"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five transducers read words letter by letter and write a class with a weight: insult, threat,
target, negation and reported speech. They share one trie, so a word is read once. A clause
automaton composes their output in order: an insult counts with its weight, less behind a
negation within reach or inside reported speech, more beside a target; a threat counts only
once a target follows it. What it reads goes into a logistic function: the strongest clause, the
density of all, and the sums of plain, negated, reported, aimed and threatening matches, each with
a slope of its own.

The word lists below are starting values. From labelled rows the insult transducer learns further
words and stems of any language: words and word beginnings that, over distinct documents, occur
mostly in toxic ones. Their weights, and those of listed insults and threats, are log odds. Words
before insults are learned from the same rows: those that go with clean documents become
negations (within reach) or reports (further ahead), those that go with toxic ones targets. The
slopes are fitted to rows that the patterns were not learned from; without evidence they stay
at the factors below.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm.arrowtext import BYTE_VALUE_LOWER, per_row, runs, slices, span_hashes
from basalt.llm.near_dedup import shingle_sets
from basalt.llm.sampling import sampled_texts
from basalt.session import scratch_path

INSULT, THREAT, TARGET, NEGATION, REPORT, END = "insult", "threat", "target", "negation", "report", "end"

# Starting word lists (fixed values), English, German, French, Spanish. A pattern is a word
# beginning; a trailing $ means the whole word, a trailing + that at least one letter follows.
SEEDS = {
    INSULT: [
        "clown$", "disgusting$", "idiot", "imbecile", "loser$", "moron", "pathetic$", "scum$", "stupid", "trash$", "vermin$", "worthless$",
        "abschaum$", "dummkopf", "trottel", "widerlich", "crétin", "imbécil", "ordure$", "salaud", "asqueros", "estúpid",
    ],
    THREAT: [
        "beat$", "destroy$", "hang$", "hurt$", "kill$", "murder$", "shoot$", "stab$", "strangle$",
        "erschieße", "töte$", "verprügel", "frapper$", "tuerai$", "étrangler", "golpear", "mataré$", "mataremos$",
    ],
    TARGET: [
        "you$", "your$", "yourself$", "he$", "him$", "she$", "they$", "them$", "these$", "those$", "people$",
        "dich$", "dir$", "du$", "euch$", "ihr$", "toi$", "tu$", "vous$", "votre$", "te$", "tú$", "usted$", "ustedes$", "vosotros$",
    ],
    NEGATION: [
        "not$", "no$", "never$", "isn$", "aren$", "wasn$", "don$", "doesn$", "without$", "nobody$",
        "kein$", "keine$", "keiner$", "nicht$", "nie$", "niemals$", "ohne$", "aucun$", "aucune$", "jamais$", "pas$", "sans$", "jamás$", "ningún$", "ninguna$", "nunca$", "tampoco$",
    ],
    REPORT: [
        "said$", "says$", "wrote$", "claimed$", "called$", "quoted$", "reported$", "according$", "allegedly$", "accused$",
        "angeblich$", "behauptete$", "nannte$", "sagte$", "schrieb$", "affirmé$", "appelé$", "prétendument$", "selon$", "afirmó$", "dijo$", "escribió$", "llamó$", "según$",
    ],
}
SEED_WEIGHT = 2.0
REACH = 3  # words over which a negation holds
NEGATED, REPORTED, AIMED = 0.3, 0.4, 1.25  # factors of the clause automaton
MAX_WEIGHT = 4.0
# Slopes without evidence: constant, strongest clause, plain, negated, reported, aimed, threats, density
PRIOR = (0.0, 0.5, 1.0, NEGATED, REPORTED, AIMED - 1, 1.0, 0.0)

_WORD = np.zeros(256, bool)
_WORD[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_CLAUSE_END = np.zeros(256, np.int64)
_CLAUSE_END[[ord(c) for c in ".!?;\n"]] = 1
_QUOTE = np.zeros(256, np.int64)
_QUOTE[ord('"')] = 1
# Scripts that put no blanks between words, words of other scripts, and sentence marks beyond ASCII
_UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
_PIECE = regex.compile(rf"(?V1)(?P<joined>[{_UNSPACED}]+)|(?P<word>[[\p{{L}}\p{{M}}]--[{_UNSPACED}]]+)|(?P<end>[。！？．｡…؟۔।॥\u2028\u2029])")
CACHE_WORDS = 1_000_000


@dataclass
class Model:
    """Patterns with (class, weight) and the logistic function's intercept and slopes."""

    patterns: dict[str, tuple[str, float]] = field(default_factory=dict)
    logit: tuple[float, ...] = (-3.0, 1.5, 0.3, 0.1, 0.1, 0.1, 0.3, 0.0)

    @classmethod
    def from_seeds(cls) -> Model:
        return cls({p: (kind, SEED_WEIGHT if kind in (INSULT, THREAT) else 1.0) for kind, words in SEEDS.items() for p in words})


class Transducer:
    """All patterns as one trie of letters; a word's output is that of its longest pattern."""

    def __init__(self, patterns: dict[str, tuple[str, float]]):
        self.root: dict = {}
        for pattern, out in patterns.items():
            node = self.root
            for letter in pattern:
                node = node.setdefault(letter, {})
            node[""] = out

    def read(self, word: str) -> tuple[str, float] | None:
        node, out = self.root, None
        for letter in word:
            out = node["+"].get("", out) if "+" in node else out
            node = node.get(letter)
            if node is None:
                return out
            out = node.get("", out)
        return node["$"].get("", out) if "$" in node else out

    def read_joined(self, text: str) -> list[tuple[str, float]]:
        """Outputs in a script without blanks: from left to right the longest pattern at any letter."""
        out, i = [], 0
        while i < len(text):
            node, found, end = self.root, None, i + 1
            for j in range(i, len(text)):
                node = node.get(text[j])
                if node is None:
                    break
                here = node.get("") or node.get("$", {}).get("")
                if here:
                    found, end = here, j + 1
            if found:
                out.append(found)
            i = end
        return out

    def read_run(self, run: str) -> tuple[tuple[str, float], ...]:
        """All outputs, in order, of a run of word bytes; it may hold several words and sentence marks."""
        out = []
        for m in _PIECE.finditer(run.lower()):
            if m.lastgroup == "word":
                found = self.read(m.group())
                if found:
                    out.append(found)
            elif m.lastgroup == "joined":
                out += self.read_joined(m.group())
            else:
                out.append((END, 0.0))
        return tuple(out)


# What the clause automaton reads from a document
TOP, TOTAL, CLAUSES, WORDS, PLAIN, DENIED, TOLD, AT_SOMEONE, THREATS = range(9)


def read_clauses(tokens: list[tuple[int, int, bool, tuple]]) -> list[float]:
    """The clause automaton over one document's matched runs, in order.

    A token is (clause, word number, inside quotes, outputs of its words). The result: the strongest
    clause, the sum over clauses, the number of clauses in which an insult, or a threat with its
    target, was read, 0, and the sums of plain, negated, reported, aimed and threatening matches.
    """
    out = [0.0] * 9
    clause, negated_at, reported, aimed, threat, score, plain, hit = None, -(10**9), False, False, 0.0, 0.0, 0.0, False

    def close():
        if hit:
            whole = score * (AIMED if aimed else 1.0)
            out[TOP], out[TOTAL], out[CLAUSES] = max(out[TOP], whole), out[TOTAL] + whole, out[CLAUSES] + 1
            out[AT_SOMEONE] += plain if aimed else 0.0

    for at, number, quoted, outputs in tokens:
        for kind, weight in outputs:
            if at != clause or kind == END:
                close()
                clause, negated_at, reported, aimed, threat, score, plain, hit = at, -(10**9), False, False, 0.0, 0.0, 0.0, False
            negated, told = number - negated_at <= REACH, reported or quoted
            factor = (NEGATED if negated else 1.0) * (REPORTED if told else 1.0)
            if kind == INSULT:
                score, hit = score + weight * factor, True
                plain += 0.0 if negated or told else weight
                out[DENIED if negated else TOLD if told else PLAIN] += weight
            elif kind == THREAT:
                threat = weight * factor
            elif kind == TARGET:
                aimed = True
                if threat:
                    score, hit, threat, out[THREATS] = score + threat, True, 0.0, out[THREATS] + threat
            elif kind == NEGATION:
                negated_at = number
            elif kind == REPORT:
                reported = True
    close()
    return out


class Reader:
    """Matches and clauses of text slices; keeps what it has read of each distinct run."""

    def __init__(self, model: Model):
        self.transducer = Transducer(model.patterns)
        self.outputs: list[tuple] = [()]
        self.codes: dict[tuple, int] = {(): 0}
        self.core = [False]  # whether an output holds an insult or a threat
        self.cache: dict[int, int] = {}

    def features(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(rows, 9): what :func:`read_clauses` gives, and the number of words."""
        out = np.zeros((len(offsets) - 1, 9))
        starts, ends = runs(_WORD[raw], offsets)
        out[:, WORDS] = np.diff(per_row(starts, offsets))
        if not len(starts):
            return out
        codes = self.read(raw, starts, ends)
        hits = np.flatnonzero(codes)
        clause = np.cumsum(_CLAUSE_END[raw])[starts[hits]]
        core = clause[np.array(self.core)[codes[hits]]]
        near = np.isin(clause, core)  # nothing counts in a clause without insult or threat
        hits, clause = hits[near], clause[near]
        if not len(hits):
            return out
        row = np.searchsorted(offsets, starts[hits], side="right") - 1
        quotes = np.concatenate([[0], np.cumsum(_QUOTE[raw])])
        quoted = (quotes[starts[hits]] - quotes[offsets[row]]) % 2 == 1
        first = np.searchsorted(row, np.arange(len(out) + 1))
        tokens = list(zip(clause.tolist(), hits.tolist(), quoted.tolist(), [self.outputs[c] for c in codes[hits].tolist()]))
        for r in np.unique(row).tolist():
            words = out[r, WORDS]
            out[r] = read_clauses(tokens[first[r] : first[r + 1]])
            out[r, WORDS] = words
        return out

    def read(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each run's outputs (0: none)."""
        which, distinct = pd.factorize(span_hashes(BYTE_VALUE_LOWER[raw], starts, ends))
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        keys = distinct.tolist()
        got = [self.cache.get(h) for h in keys]
        missing = [i for i, c in enumerate(got) if c is None]
        if missing:
            place = np.empty(len(keys), np.int64)
            place[which[::-1]] = np.arange(len(which) - 1, -1, -1)
            text = raw.tobytes()
            for i, a, b in zip(missing, starts[place[missing]].tolist(), ends[place[missing]].tolist()):
                found = self.transducer.read_run(text[a:b].decode("utf-8", "replace"))
                code = self.codes.setdefault(found, len(self.outputs))
                if code == len(self.outputs):
                    self.outputs.append(found)
                    self.core.append(any(kind in (INSULT, THREAT) for kind, _ in found))
                got[i] = self.cache[keys[i]] = code
        return np.asarray(got, np.int64)[which]

    def contexts(self, raw: np.ndarray, offsets: np.ndarray) -> list[tuple[set[str], set[str]]]:
        """Per row the words up to REACH before an insult of their clause, and those further ahead."""
        out: list[tuple[set[str], set[str]]] = [(set(), set()) for _ in offsets[1:]]
        starts, ends = runs(_WORD[raw], offsets)
        if not len(starts):
            return out
        codes = self.read(raw, starts, ends)
        insult = np.array([any(kind == INSULT for kind, _ in o) for o in self.outputs])[codes]
        clause = np.cumsum(_CLAUSE_END[raw])[starts]
        row = np.searchsorted(offsets, starts, side="right") - 1
        text = raw.tobytes()
        for i in np.flatnonzero(insult).tolist():
            near, far = out[row[i]]
            for j in range(i - 1, max(-1, i - 40), -1):
                if clause[j] != clause[i] or row[j] != row[i]:
                    break
                if not insult[j]:
                    words = _words(text[starts[j] : ends[j]].decode("utf-8", "replace"))
                    (near if i - j <= REACH else far).update(words)
        return out


def _words(text: str) -> set[str]:
    return {m.group() for m in _PIECE.finditer(text.lower()) if m.lastgroup == "word"}


def _beginnings(text: str, longest: int) -> set[str]:
    """All patterns that some word of the text matches; in scripts without blanks, pieces of 2 to 4 letters."""
    out, words, joined = set(), set(), set()
    for m in _PIECE.finditer(text.lower()):
        (words if m.lastgroup == "word" else joined if m.lastgroup == "joined" else set()).add(m.group())
    out |= {f"{w}$" for w in words if 3 <= len(w) <= longest}
    for w in words:
        for k in range(3, min(len(w), longest) + 1):
            out.add(w[:k])
            if len(w) > k:
                out.add(f"{w[:k]}+")
    for w in joined:
        out |= {w[i : i + k] for k in (2, 3, 4) for i in range(len(w) - k + 1)}
    return out


def _evidence(pos: int, neg: int, toxic: int, clean: int) -> float:
    """Log-likelihood ratio of a pattern's share of toxic documents against the base share."""
    share, base = pos / (pos + neg), toxic / (toxic + clean)
    if share <= base:
        return 0.0
    return 2 * (pos * math.log(share / base) + (neg * math.log((1 - share) / (1 - base)) if neg else 0.0))


def learn_patterns(counts: dict[str, tuple[int, int]], toxic: int, clean: int, purity: float = 0.5, evidence: float = 30.0) -> dict[str, float]:
    """Insult patterns with weights from (toxic, clean) document counts of patterns.

    Candidates hold ``purity`` toxic documents at least and ``evidence`` that chance does not give
    among a million candidates. The strongest comes first (of equals the longer); a pattern
    that covers a taken one, or that a taken one covers, is left out.
    """
    if not toxic or not clean:
        return {}
    strength = {p: _evidence(*c, toxic, clean) for p, c in counts.items() if c[0] >= 5 and c[0] >= purity * (c[0] + c[1])}
    strong = sorted((p for p, g in strength.items() if g >= evidence), key=lambda p: (-strength[p], -len(p.rstrip("$+")), p))
    taken: dict[str, float] = {}
    whole, longer, exact = set(), set(), set()  # taken beginnings by kind
    above = set()  # beginnings that cover a taken pattern
    for pattern in strong:
        stem = pattern.rstrip("$+")
        covered = any(stem[:k] in whole or stem[:k] in longer for k in range(3, len(stem))) or stem in whole or pattern[-1] == "+" and stem in longer
        covers = stem in above or pattern[-1] != "$" and (stem in longer or pattern[-1] != "+" and stem in exact)
        if covered or pattern in taken or (covers and pattern[-1] != "$"):
            continue
        (exact if pattern[-1] == "$" else longer if pattern[-1] == "+" else whole).add(stem)
        above.update(stem[:k] for k in range(3, len(stem)))
        pos, neg = counts[pattern]
        taken[pattern] = min(MAX_WEIGHT, math.log((pos + 0.5) / (neg + 0.5) * clean / toxic))
    return taken


def _design(f: np.ndarray) -> np.ndarray:
    """Columns of the logistic function: 1, strongest clause, logs of the five sums, log of the density."""
    logs = [np.log1p(f[:, i]) for i in (PLAIN, DENIED, TOLD, AT_SOMEONE, THREATS)]
    return np.column_stack([np.ones(len(f)), np.minimum(f[:, TOP], 2 * MAX_WEIGHT), *logs, np.log1p(1000 * f[:, TOTAL] / (f[:, WORDS] + 50))])


def fit_logit(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[float, ...]:
    """Logistic regression on clause features by Newton steps, with slopes drawn to PRIOR."""
    x, prior = _design(features), np.array(PRIOR)
    penalty = ridge * len(x) * np.diag([0.0] + [1.0] * (x.shape[1] - 1))

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - labels * z).sum() + (w - prior) @ penalty @ (w - prior) / 2)

    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (labels - p) - penalty @ (w - prior)
        hess = (x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-6 * np.eye(len(w))
        move = np.clip(np.linalg.solve(hess, grad), -2, 2)
        while loss(w + move) > loss(w) and np.abs(move).max() > 1e-8:  # too far: half the way
            move /= 2
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def apply_logit(features: np.ndarray, logit: tuple[float, ...]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_design(features) @ np.asarray(logit), -30, 30)))


def learn_contexts(counts: dict[str, tuple[int, int, int, int]], toxic: int, clean: int, evidence: float = 30.0) -> dict[str, tuple[str, float]]:
    """Negations, reports and targets from the words before insults.

    ``counts``: per word the (toxic, clean) documents that have it within reach of an insult, and
    those that have it further ahead; ``toxic`` and ``clean``: documents with an insult. A word that goes
    with clean documents within reach negates, one that does so only further ahead reports; one that
    goes with toxic documents is a target. Words before more than half of the insults are left out.
    """
    out: dict[str, tuple[str, float]] = {}
    if not toxic or not clean:
        return out
    for word, (t, c, far_t, far_c) in counts.items():
        if 2 * (t + c) > toxic + clean:  # before most insults: a word like "the"
            continue
        if c >= 5 and _evidence(c, t, clean, toxic) >= evidence:
            out[f"{word}$"] = (NEGATION, 1.0)
        elif far_c >= 5 and _evidence(far_c, far_t, clean, toxic) >= evidence:
            out[f"{word}$"] = (REPORT, 1.0)
        elif t >= 5 and _evidence(t, c, toxic, clean) >= evidence:
            out[f"{word}$"] = (TARGET, 1.0)
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12_000, sample_bytes: int = 64 << 20, longest: int = 12, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit the grammar to labelled rows (``id``, ``label`` 0/1; others are ignored).

    ``sample`` bounds the rows read for fitting, half of each label at most, and ``sample_bytes`` their
    text; of rows that share their least shingle and label, as copies do, one counts. Without rows
    of both labels, as for an empty table, the starting lists and weights are returned. Null texts
    are empty.
    """
    spark = docs.sparkSession
    labels = labels.filter("id is not null and label in (0, 1)").withColumn("label", F.col("label").cast("int"))
    texts = sampled_texts(docs, labels, sample, sample_bytes, id_col, text_col)

    def least_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, raw, offsets in slices(batch, "text"):
                sets, bounds = shingle_sets(raw, offsets, 3)
                least = np.zeros(len(bounds) - 1, np.uint64)
                full = np.diff(bounds) > 0
                least[full] = sets[bounds[:-1][full]]  # the sets are sorted
                yield pa.record_batch([*some.columns, pa.array(least.view(np.int64))], names=["id", "text", "label", "cluster"])

    marked = texts.mapInArrow(least_shingle, T.StructType([*texts.schema, T.StructField("cluster", T.LongType())]))
    path = scratch_path(spark, "toxicity-sample")
    rows = marked.groupBy("cluster", "label").agg(F.min(F.struct("id", "text")).alias("first"))
    rows.select(F.col("first.text").alias("text"), "label", F.pmod(F.xxhash64("cluster"), F.lit(2)).cast("int").alias("half")).write.parquet(path)
    rows = spark.read.schema("text string, label int, half int").parquet(path)
    totals = {(r[0], r[1]): r[2] for r in rows.groupBy("half", "label").count().collect()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], Counter] = {(h, y): Counter() for h in (0, 1) for y in (0, 1)}
        for batch in batches:
            for text, label, half in zip(*batch.columns):
                seen[half.as_py(), label.as_py()].update(_beginnings(text.as_py() or "", longest))
        for half in (0, 1):
            clean, toxic = seen[half, 0], seen[half, 1]
            every = list(clean.keys() | toxic.keys())
            yield pa.record_batch({
                "p": pa.array(every, pa.string()), "half": pa.array([half] * len(every), pa.int32()),
                "toxic": pa.array([toxic[p] for p in every], pa.int64()), "clean": pa.array([clean[p] for p in every], pa.int64()),
            })

    model = Model.from_seeds()
    if not all(totals.get((h, y)) for h in (0, 1) for y in (0, 1)):
        return model
    both = [F.sum(F.when(F.col("half") == h, F.col(c)).otherwise(0)).alias(f"{c}{h}") for h in (0, 1) for c in ("toxic", "clean")]
    found = rows.mapInArrow(count, "p string, half int, toxic long, clean long").groupBy("p").agg(*both)
    seeds = [p for words in SEEDS.values() for p in words]
    pos, neg = F.col("toxic0") + F.col("toxic1"), F.col("clean0") + F.col("clean1")
    likely = (pos >= 5) & (pos >= neg) | (F.col("toxic0") >= 5) & (F.col("toxic0") >= F.col("clean0"))
    kept = found.filter(likely | F.col("p").isin(seeds)).collect()  # patterns of a bounded sample

    def learned(halves: tuple[int, ...]) -> Model:
        counts = {r["p"]: (int(sum(r[f"toxic{h}"] for h in halves)), int(sum(r[f"clean{h}"] for h in halves))) for r in kept}
        toxic, clean = (sum(totals[h, y] for h in halves) for y in (1, 0))
        out = Model.from_seeds()
        for pattern, (kind, _) in list(out.patterns.items()):  # listed insults and threats: their weight in these rows
            a, b = counts.get(pattern, (0, 0))
            if kind in (INSULT, THREAT) and a + b >= 5:
                out.patterns[pattern] = (kind, min(MAX_WEIGHT, max(0.0, math.log((a + 0.5) / (b + 0.5) * clean / toxic))))
        for pattern, weight in learn_patterns(counts, toxic, clean).items():
            out.patterns[pattern] = (INSULT, weight)
        used = rows.filter(F.col("half").isin(*halves))
        for pattern, found in learn_contexts(*_contexts(used, out)).items():
            out.patterns.setdefault(pattern, found)
        return out

    half = learned((0,))
    measured = _measure(rows.filter("half = 1"), half, ["label"]).toPandas()  # a bounded sample
    model = learned((0, 1))
    if not (measured["total"] > 0).any():  # half of the rows showed no pattern: measure on all of them
        measured = _measure(rows, model, ["label"]).toPandas()
    model.logit = fit_logit(measured[MEASURES].to_numpy(float), measured["label"].to_numpy(float))
    return model


def _contexts(rows: DataFrame, model: Model) -> tuple[dict, int, int]:
    """Arguments of :func:`learn_contexts`, counted over rows (text, label)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, seen = Reader(model), Counter()
        for batch in batches:
            for some, raw, offsets in slices(batch, "text"):
                insulted = reader.features(raw, offsets)[:, [PLAIN, DENIED, TOLD]].any(axis=1)
                for label, (near, far), hit in zip(some.column(1).to_pylist(), reader.contexts(raw, offsets), insulted.tolist()):
                    if hit:
                        seen["", label, False] += 1
                        seen.update((w, label, False) for w in near)
                        seen.update((w, label, True) for w in far - near)
        yield pa.record_batch({"word": pa.array([k[0] for k in seen], pa.string()), "label": pa.array([k[1] for k in seen], pa.int32()), "far": pa.array([k[2] for k in seen], pa.bool_()), "n": pa.array(list(seen.values()), pa.int64())})

    sums = rows.select("text", "label").mapInArrow(count, "word string, label int, far boolean, n long").groupBy("word").agg(
        *[F.sum(F.when((F.col("label") == y) & (F.col("far") == far), F.col("n")).otherwise(0)).alias(f"n{y}{int(far)}") for far in (False, True) for y in (1, 0)]
    )
    kept = sums.filter("word = '' or greatest(n10, n00, n11, n01) >= 5").collect()  # words of a bounded sample
    counts = {r["word"]: (r["n10"], r["n00"], r["n11"], r["n01"]) for r in kept}
    toxic, clean = counts.pop("", (0, 0, 0, 0))[:2]
    return counts, toxic, clean


MEASURES = ["top", "total", "clauses", "words", "plain", "negated", "reported", "aimed", "threats"]


def _measure(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns of rows, then MEASURES and the score. Null text counts as empty."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            for some, raw, offsets in slices(batch, "text"):
                f = reader.features(raw, offsets)
                yield pa.record_batch({**{c: some.column(i) for i, c in enumerate(keep)}, **{c: f[:, i] for i, c in enumerate(MEASURES)}, "score": apply_logit(f, model.logit)})

    fields = [*[T.StructField(c, rows.schema[c].dataType) for c in keep], *[T.StructField(c, T.DoubleType()) for c in (*MEASURES, "score")]]
    return rows.select(*keep, "text").mapInArrow(read, T.StructType(fields))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``score`` (0 to 1), ``predicted`` (1 from 0.5), ``clauses`` and ``top_clause``.

    Every row is scored on its whole text, repeated rows and null ids too; null and empty texts
    get the score of a text without a matched clause. Other columns are not read; an empty
    table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return _measure(rows, model, ["id"]).select(
        F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.col("clauses").cast("int").alias("clauses"), F.col("top").alias("top_clause")
    )


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, without the rows that the model scores at 0.5 or more.

    Null and empty texts have no matched clause; they stay unless the model scores such texts so
    high. Repeated rows and null ids are kept or dropped by their text; an empty table stays empty.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            for some, raw, offsets in slices(batch, text_col):
                yield some.filter(pa.array(apply_logit(reader.features(raw, offsets), model.logit) < 0.5))

    return docs.mapInArrow(keep, docs.schema)
