"""Toxicity by a learned lexicon, Levenshtein automata over its trie, and context windows.

Fit (:func:`fit`), on at most about ``sample`` labelled rows, half of them of each class where there are as many:

1. Rows whose texts have the same least word shingle (under one of two hashes) are copies; one stays.
2. On two thirds of them, every word and every beginning of a word (``STEMS`` letters) is counted in the
   documents of either class, up to ``TIMES`` in each. Terms that are more frequent in toxic documents than chance allows, among
   so many candidates, make up the lexicon; of terms that begin alike the most telling stays.
3. The lexicon is run over the same rows: each (term, edits) gets the log odds of documents with it,
   drawn towards a part of the exact term's where it is rarely seen.
4. On the last third, a logistic regression turns a document's evidence into a score.

Scan (:func:`score_documents`), a single pass without a shuffle: the words ``[^\\W_]+`` of the whole
lower-cased text go through an automaton that accepts all words within ``allowed(term)`` edits of a term,
or beginning so for a stem. It is the product of the terms' trie and their Levenshtein automata, made
deterministic state by state as words are met; a word is run once and remembered. A hit's weight is then
scaled by what stands around it: inside quotation marks or a quoted line, near words of reporting, or
addressed to somebody.

Null and empty texts have no words and get the score of no evidence; without labelled rows of both
classes every score is 0; rows with a null id are scored but never learned from; repeated rows get equal
scores; equal evidence for two terms goes to the longer one, then by the alphabet; long texts are read
in pieces and contexts across them; no documents give no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, mix, release, small_side, space_words, steps, window_hashes, word_hashes, written

#: Labelled rows that a fit looks at, and terms that a lexicon has at most.
SAMPLE, TERMS = 12_000, 400
#: Letters of a stem; documents that a term has to be in; the largest log odds of one hit.
STEMS, SUPPORT, MOST = range(3, 9), 4, 6.0
#: Occurrences in one document that count when terms are looked for.
TIMES = 5
#: A misspelled term counts as this part of the term for each edit, until seen otherwise.
PER_EDIT = 0.6
#: Characters around a hit within which quotation marks are looked for, and words for the rest.
REACH, WINDOW = 300, 8
#: What a hit counts for inside quotation marks, near a word of reporting, and when addressed to somebody.
QUOTED, REPORTED, DIRECTED = 0.25, 0.6, 1.3
PIECE = 1 << 20
_WORD = re.compile(r"[^\W_]+")
_CLOSES = {'"': '"', "“": "”", "„": "“”", "«": "»", "»": "«", "‹": "›", "‘": "’"}
_MARK = re.compile("[" + "".join(sorted({*_CLOSES, *"".join(_CLOSES.values())})) + "]")
REPORTING = frozenset("said says say called calls calling word words term terms quote quotes quoted quoting wrote writes cited means meaning definition slur slurs sagte sagt nannte wort zitat zitiert dit disait mot terme citation cita dijo dice palabra llamó".split())
ADDRESS = frozenset("you your youre yours yourself u du dich dir dein deine ihr euch tu toi te ton vous votre tú ti usted ustedes vos".split())


def allowed(letters: str) -> int:
    """Edits that a term may be misspelled by."""
    return 0 if len(letters) < 5 else 1 if len(letters) < 9 else 2


class Automaton:
    """All words within some edits of a term, with the terms and the edits."""

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms, self.children, self.ends, self.room = terms, [{}], [[]], [0]
        for number, (letters, _) in enumerate(terms):
            node = 0
            for c in letters:
                self.room[node] = max(self.room[node], allowed(letters))
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.room.append(0)
                node = self.children[node][c]
            self.room[node] = max(self.room[node], allowed(letters))
            self.ends[node].append(number)
        self.letters = {c for children in self.children for c in children}
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.whole: list[tuple] = []
        self.begun: list[tuple] = []
        self.known: dict[str, tuple] = {}
        self.start = self._number({0: 0})

    def _number(self, nodes: dict[int, int]) -> int:
        """The state of these trie nodes (with the fewest edits), letters left out by the word included; -1: none."""
        queue = list(nodes.items())
        while queue:
            node, edits = queue.pop()
            if nodes[node] != edits:
                continue
            for child in self.children[node].values():
                if edits + 1 <= self.room[child] and nodes.get(child, 99) > edits + 1:
                    nodes[child] = edits + 1
                    queue.append((child, edits + 1))
        if not nodes:
            return -1
        key = tuple(sorted(nodes.items()))
        if key not in self.numbers:
            ended = [(t, e) for node, e in key for t in self.ends[node] if e <= allowed(self.terms[t][0])]
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            self.whole.append(tuple(ended))
            self.begun.append(tuple((t, e) for t, e in ended if self.terms[t][1]))
        return self.numbers[key]

    def _move(self, state: int, letter: str) -> int:
        nodes: dict[int, int] = {}
        for node, edits in self.states[state]:
            if edits + 1 <= self.room[node]:  # one letter too many
                nodes[node] = min(nodes.get(node, 99), edits + 1)
            for c, child in self.children[node].items():
                e = edits + (c != letter)
                if e <= self.room[child]:
                    nodes[child] = min(nodes.get(child, 99), e)
        self.moves[state][letter] = to = self._number(nodes)
        return to

    def hits(self, word: str) -> tuple[tuple[int, int], ...]:
        """``(term, edits)`` of the terms that the word is, or begins with."""
        found = self.known.get(word)
        if found is None:
            state, best = self.start, {}
            for c in word:
                letter = c if c in self.letters else ""
                to = self.moves[state].get(letter)
                state = self._move(state, letter) if to is None else to
                if state < 0:
                    break
                for t, e in self.begun[state]:
                    best[t] = min(best.get(t, 99), e)
            for t, e in self.whole[state] if state >= 0 else ():
                best[t] = min(best.get(t, 99), e)
            if len(self.known) >= 500_000:
                self.known.clear()
            found = self.known[word] = tuple(sorted(best.items()))
        return found


def pieces(text: str):
    """``(start, end)`` of parts of about ``PIECE`` characters that end before a blank, if there is one."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield at, end
        at = end


def quoted(text: str, begin: int, end: int) -> bool:
    """Whether the span stands between quotation marks, or in a line that begins with ``>``."""
    left = text[max(0, begin - REACH) : begin].rpartition("\n")[2]
    right = text[end : end + REACH].partition("\n")[0]
    if left.startswith(">"):
        return True
    opened = ""
    for m in _MARK.findall(left):
        if opened and m in _CLOSES[opened]:
            opened = ""
        elif not opened and m in _CLOSES:
            opened = m
    return bool(opened) and any(c in right for c in _CLOSES[opened])


def context(text: str, begin: int, end: int) -> tuple[bool, float]:
    """Whether a span is quoted, and what it counts for by what stands around it."""
    before = _WORD.findall(text[max(0, begin - 12 * WINDOW) : begin])[-WINDOW:]
    after = _WORD.findall(text[end : end + 12 * WINDOW])[:WINDOW]
    inside = quoted(text, begin, end)
    factor = QUOTED if inside else DIRECTED if not ADDRESS.isdisjoint(before + after) else 1.0
    return inside, factor * (REPORTED if not REPORTING.isdisjoint(before + after[:3]) else 1.0)


@dataclass(frozen=True)
class Toxicity:
    """``terms``: letters and whether they are a stem; ``weights[t][e]``: of a hit with e edits; ``coefficients``: of :func:`evidence`."""

    terms: tuple[tuple[str, bool], ...] = ()
    weights: tuple[tuple[float, ...], ...] = ()
    coefficients: tuple[float, ...] | None = None


def spans(text: str, machine: Automaton, weights) -> tuple[int, list[tuple[int, int, int, int, bool, float]]]:
    """Number of words, and ``(begin, end, term, edits, quoted, weight)`` of the best term of each word that hits one."""
    n, out = 0, []
    for start, stop in pieces(text):
        part = text[start:stop]
        words = _WORD.findall(part)
        n += len(words)
        best = {}
        for word in set(words):
            hits = machine.hits(word)
            if hits:
                t, e = max(hits, key=lambda h: (weights[h[0]][h[1]], -h[0]))
                if weights[t][e] > 0:
                    best[word] = (t, e)
        if best:
            for m in _WORD.finditer(part):
                if m[0] in best:
                    (t, e), begin, end = best[m[0]], start + m.start(), start + m.end()
                    inside, factor = context(text, begin, end)
                    out.append((begin, end, t, e, inside, weights[t][e] * factor))
    return n, out


def evidence(n_words: int, weights: list[float]) -> tuple[float, float, float]:
    """Features of a document: all evidence, evidence per word, and the best hit's."""
    total = sum(weights)
    return math.log1p(total), math.log1p(100 * total / (n_words + 20)), max(weights, default=0.0) / MOST


def _score(features: np.ndarray, coefficients) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ np.asarray(coefficients[1:]) + coefficients[0], -700, 700)))


# --- the scan -------------------------------------------------------------------------------

_HIT = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("term", pa.string()), ("edits", pa.int32()), ("quoted", pa.bool_()), ("weight", pa.float64())])
_HIT_DDL = "array<struct<begin:bigint,end:bigint,term:string,edits:int,quoted:boolean,weight:double>>"


def score_documents(docs: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, hits, features, score)``; hits are spans of the lower-cased text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most TERMS terms

    def run(batches):
        model = shared.value
        machine, names = Automaton(list(model.terms)), [letters + "*" * stem for letters, stem in model.terms]
        for batch in steps(batches, "text"):
            counts, found = [], []
            for text in batch.column(1):
                n, own = spans((text.as_py() or "").lower(), machine, model.weights)
                counts.append(n)
                found.append(own)
            features = np.array([evidence(n, [h[5] for h in own]) for n, own in zip(counts, found, strict=True)])
            score = _score(features, model.coefficients) if model.coefficients else np.zeros(len(features))
            hits = [[{"begin": b, "end": e, "term": names[t], "edits": k, "quoted": q, "weight": w} for b, e, t, k, q, w in own] for own in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(hits, pa.list_(_HIT)), pa.array(features.tolist(), pa.list_(pa.float64())), pa.array(score)], ["doc_id", "n_words", "hits", "features", "score"])
        release()

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"doc_id long, n_words long, hits {_HIT_DDL}, features array<double>, score double")


# --- the fit --------------------------------------------------------------------------------


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> DataFrame:
    """``(doc_id, text, toxic, share, check)``, written: sampled labelled rows, one of each group of copies.

    ``share`` is the part of its class that was drawn; ``check`` marks the third that calibrates.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where("toxic in (0, 1) and doc_id is not null")
    known = known.where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, sample / 2 / max(1, sizes.get(1, 0)))).otherwise(min(1.0, sample / 2 / max(1, sizes.get(0, 0))))
    drawn = known.withColumn("share", share).where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.lit(1_000_000)) < F.col("share") * 1_000_000)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    rows = texts.join(small_side(written(drawn, "drawn")), "doc_id")

    def keys(batches):
        for batch in steps(batches):
            words, bounds = word_hashes(as_bytes(batch.column(batch.schema.get_field_index("text"))), space_words())
            found = []
            for a, z in zip(bounds[:-1], bounds[1:], strict=True):
                h = window_hashes(words[a:z], min(5, max(1, z - a)))
                found.append((int(h.min()) >> 1, int(mix(h ^ np.uint64(0x5BD1E995)).min()) >> 1) if len(h) else (0, 0))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([f[i] for f in found], pa.int64()) for i in (0, 1))], [*batch.schema.names, "k0", "k1"])

    keyed = rows.mapInArrow(keys, "doc_id long, text string, toxic int, share double, k0 long, k1 long")
    for k in ("k0", "k1"):
        keyed = keyed.groupBy(k).agg(F.min_by(F.struct(*(c for c in ("doc_id", "text", "toxic", "share", "k0", "k1") if c != k)), "doc_id").alias("r")).select(k, "r.*")
    return written(keyed.select("doc_id", "text", "toxic", "share", (F.pmod(F.xxhash64(F.col("doc_id"), F.lit(2)), F.lit(3)) == 0).alias("check")), "learnable")


def mine_terms(rows: DataFrame, toxic: float, clean: float, most: int = TERMS) -> list[tuple[str, bool]]:
    """The lexicon of ``rows`` (text, toxic), of which so many are toxic and clean."""

    def run(batches):
        times, seen = (Counter(), Counter()), (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text, words, own = text.lower(), Counter(), Counter()
                for a, z in pieces(text):
                    words.update(_WORD.findall(text[a:z]))
                for word, n in words.items():
                    if len(word) >= STEMS[0] and not word.isdigit():
                        own.update({word[:k]: n for k in STEMS if k <= len(word)} | ({f"{word}$": n} if len(word) <= 40 else {}))
                seen[label].update(own.keys())
                times[label].update({t: min(n, TIMES) for t, n in own.items()})
        for label in (0, 1):
            terms = [*seen[label]]
            for at in range(0, len(terms), 50_000):
                part = terms[at : at + 50_000]
                counts = [pa.array([c[label][t] for t in part], pa.int64()) for c in (times, seen)]
                zeros = [pa.array(np.zeros(len(part), np.int64))] * 2
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(counts + zeros if label else zeros + counts)], ["term", "a", "docs_a", "b", "docs_b"])

    sums = [F.sum(c).alias(c) for c in ("a", "docs_a", "b", "docs_b")]
    counted = rows.select("text", "toxic").mapInArrow(run, "term string, a long, docs_a long, b long, docs_b long").groupBy("term").agg(*sums)
    counted = written(counted.where(F.col("docs_a") + F.col("docs_b") >= SUPPORT), "terms")
    tested = counted.count()
    a, b, docs = F.col("a").cast("double"), F.col("b").cast("double"), F.col("docs_a") + F.col("docs_b")
    rate = (a + b) / (toxic + clean)
    part = lambda x, n: F.when(x > 0, x * F.log(x / (n * rate))).otherwise(0.0)
    g2 = 2 * (part(a, toxic) + part(b, clean))
    # occurrences in one document are no independent witnesses: the test is scaled down to documents
    told = counted.where((F.col("docs_a") >= SUPPORT) & (a * clean > 3 * b * toxic)).withColumn("g2", g2).where(F.col("g2") * docs / (a + b) > 2 * math.log(20 * max(tested, 1)))
    lexicon: list[str] = []
    for r in told.orderBy(F.desc("g2"), F.desc(F.length("term")), "term").limit(50 * most).collect():
        bare = r["term"].rstrip("$")
        if len(lexicon) < most and not any(x.rstrip("$").startswith(bare) or (bare.startswith(x) if x[-1] != "$" else bare == x[:-1]) for x in lexicon):
            lexicon.append(r["term"])
    return [(t.rstrip("$"), t[-1] != "$") for t in lexicon]


def weigh_terms(rows: DataFrame, terms: list[tuple[str, bool]], toxic: float, clean: float) -> tuple[tuple[float, ...], ...]:
    """Log odds of each term's hits by edits, from documents (text, toxic)."""
    shared = rows.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        machine, counts = Automaton(shared.value), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text, found = text.lower(), set()
                for a, z in pieces(text):
                    for word in set(_WORD.findall(text[a:z])):
                        found.update(machine.hits(word))
                counts.update((t, e, label) for t, e in found)
        keys = [*counts]
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], pa.int64()) for i in range(3)] + [pa.array([counts[k] for k in keys], pa.int64())], ["term", "edits", "label", "n"])

    seen = Counter()
    for r in rows.select("text", "toxic").mapInArrow(run, "term long, edits long, label long, n long").groupBy("term", "edits", "label").agg(F.sum("n").alias("n")).collect():  # at most six for a term
        seen[r["term"], r["edits"], r["label"]] = r["n"]
    out = []
    for t in range(len(terms)):
        weights = [min(MOST, max(0.0, math.log((seen[t, 0, 1] * clean / toxic + 0.5) / (seen[t, 0, 0] + 0.5))))]
        for e in (1, 2):
            odds = math.exp(weights[0] * PER_EDIT**e)  # of one document that might have been seen
            now = (seen[t, e, 1] * clean / toxic + odds / (1 + odds)) / (seen[t, e, 0] + 1 / (1 + odds))
            weights.append(min(weights[0], max(0.0, math.log(now))))
        out.append(tuple(weights))
    return tuple(out)


def regress(x: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: float = 0.05, turns: int = 40) -> tuple[float, ...]:
    """Weighted logistic regression by Newton's method; the coefficients but the first are held to be 0 or more."""
    full = np.hstack([np.ones((len(x), 1)), x])
    free = np.ones(full.shape[1], dtype=bool)
    while True:
        beta, ridge = np.zeros(full.shape[1]), np.full(free.sum(), penalty)
        ridge[0] = 1e-6
        z = full[:, free]
        for _ in range(turns):
            p = _score(z[:, 1:], beta[free])
            h = (z * (w * p * (1 - p))[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(h, z.T @ (w * (y - p)) - ridge * beta[free])
            beta[free] += np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-8:
                break
        if (beta[1:] >= 0).all():
            return tuple(float(b) for b in beta)
        free[1:] &= beta[1:] > 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, most: int = TERMS) -> Toxicity:
    rows = learnable(docs, labels, id_col, text_col, label_col, sample)
    sizes = Counter({(r["check"], r["toxic"]): r["n"] for r in rows.groupBy("check", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()})
    toxic, clean = sizes[False, 1], sizes[False, 0]
    if not toxic or not clean:
        return Toxicity()
    learned = rows.where("not check")
    terms = mine_terms(learned, toxic, clean, most)
    model = Toxicity(tuple(terms), weigh_terms(learned, terms, toxic, clean))
    # features of the rows that calibrate; of all, where they are too few
    few = min(sizes[True, 1], sizes[True, 0]) < 20
    asked = rows if few else rows.where("check")
    scored = score_documents(asked, model).select("doc_id", "features").join(asked.select("doc_id", "toxic", "share").distinct(), "doc_id").orderBy("doc_id").collect()  # at most about `sample` rows
    x = np.array([r["features"] for r in scored])
    y, w = np.array([r["toxic"] for r in scored], dtype=float), np.array([1 / r["share"] for r in scored])
    return Toxicity(model.terms, model.weights, regress(x, y, w / w.mean()))
