"""Toxicity by a learned lexicon, matched through Levenshtein automata, and context-window scores.

The lexicon is learned from labelled documents: words and word stems that occur
in toxic documents and hardly in others, chosen greedily until every toxic
document is explained ``COVER`` times or no term explains enough more. A document's words are matched against the
lexicon's trie by a Levenshtein automaton, so misspelled terms are found too.
Each match is read in a window of words around it, which tells a quotation (the
term between quotation marks, or after a word of reporting) from abuse. A
logistic model over what the windows say gives the score.

Only the fit uses a sample: at most ``SAMPLE`` labelled documents of each class,
those with the smallest hash of their id, and of these as many as have
``SAMPLE_CHARS`` characters between them (at least one). All their terms are candidates, and
terms are chosen as long as one explains enough more, so the model has at most
``SAMPLE * COVER / least`` of them. Scoring reads every whole text once, on the map
side; the model travels in the closure.

Words are what stands between white space. Scripts that are written without spaces
are read in windows of ``UNSPACED_WINDOW`` characters, one from each character on,
of which the stems are terms.
"""

from __future__ import annotations

import heapq
import math
import re
import string
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.llm.common import materialise, worker_state
from marketflow.llm.tokens import Cache

SAMPLE = 8192
SAMPLE_CHARS = 1 << 25
COVER = 3
WINDOW = 6
STEM = range(3, 13)  # lengths of stems
WORD_LENGTHS = range(3, 25)
UNSPACED_WINDOW = 6
# The blocks of scripts written without spaces (Thai, Lao, Myanmar, Khmer, kana, Han, and Han beyond U+FFFF).
UNSPACED = re.compile("[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF]")
FUZZY_FROM = 5  # terms of at least so many letters may be one edit off
# Quotation marks, and words of reporting that make a following term a mention.
OPENING, CLOSING = "\"'“„«‘‚‹", "\"'”“»’‘›"
EDGE = string.punctuation + "“„«‘‚‹”»’›…–—¡¿"
REPORTING = frozenset("said says called calls word term quote quoted wrote dit mot terme sagte wort zitat dijo palabra cita".split())


class Lexicon:
    """A trie of terms; ``match`` walks it together with the automaton of a word."""

    def __init__(self, terms: list[tuple[str, bool, float]]):
        self.terms = terms
        self.root: dict = {}
        self.parts: dict[tuple[int, int], set[str]] = {}
        for n, (term, _, _) in enumerate(terms):
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node.setdefault("", []).append(n)
            self._index(term)

    def _index(self, term: str) -> None:
        """Parts of a term of which a word within its edits has at least one in place."""
        half = len(term) // 2 if self.edits(term) else len(term)
        self.parts.setdefault((0, half), set()).add(term[:half])
        if self.edits(term):
            tail = term[half:]
            for at in (half - 1, half, half + 1):
                self.parts.setdefault((at, at + len(tail)), set()).add(tail)

    @staticmethod
    def edits(term: str) -> int:
        return int(len(term) >= FUZZY_FROM)

    def possible(self, word: str) -> bool:
        """False only for words that no term can match: one edit leaves a term's head or tail intact."""
        for (a, b), parts in self.parts.items():
            if word[a:b] in parts:
                return True
        return False

    def match(self, word: str):
        """The best ``(weight, edits)`` of the terms that the word, or for a stem its start, is within reach of."""
        if not self.possible(word):
            return False
        at: dict[str, int] = {}
        for i, c in enumerate(word):
            at[c] = at.get(c, 0) | 1 << i
        whole = 1 << len(word)
        full = (whole << 1) - 1
        best = False
        # State: positions of the word reached with 0 and with 1 edit, as bit sets.
        todo = [(self.root, 1, 3 & full)]
        while todo:
            node, zero, one = todo.pop()
            for c, child in node.items():
                if c == "":
                    for n in child:
                        term, stem, weight = self.terms[n]
                        for edits, state in ((0, zero), (1, one)):
                            if edits <= self.edits(term) and (state if stem else state & whole):
                                if not best or (weight, -edits) > (best[0], -best[1]):
                                    best = (weight, edits)
                                break
                    continue
                hits = at.get(c, 0)
                z = (zero & hits) << 1
                o = ((one & hits) << 1 | zero | zero << 1 | z << 1) & full
                if z or o:
                    todo.append((child, z, o))
        return best


def features(text: str | None, match) -> list[float]:
    """What the windows around a text's matches say; all zero without a match."""
    words = words_of(text)
    hits = {w: found for w in set(words) if (found := match[w])}
    if not hits:
        return [0.0] * 7
    abuse, quoted, fuzzy, top, distinct = 0.0, 0.0, 0.0, 0.0, set()
    count = 0
    for i, word in enumerate(words):
        found = hits.get(word)
        if not found:
            continue
        count += 1
        weight, edits = found
        if is_quotation(words, i):
            quoted += weight
        elif edits:
            fuzzy += weight
        else:
            abuse += weight
            top = max(top, weight)
            distinct.add(word)
    return [math.log1p(abuse), top, math.log1p(len(distinct)), math.log1p(fuzzy), math.log1p(quoted),
            math.log1p(1000.0 * count / len(words)), float(abuse > 0)]


def is_quotation(words: list[str], at: int) -> bool:
    """Whether the window around a word opens a quotation before it and closes it after, or reports it."""
    before, after = words[max(0, at - WINDOW):at + 1], words[at:at + WINDOW + 1]
    opened = any(w[0] in OPENING for w in before) and not any(w[-1] in CLOSING for w in before[:-1])
    closed = any(w.rstrip(".,;:!?")[-1:] in CLOSING and w.rstrip(".,;:!?") != "" for w in after)
    reported = any(w.strip(EDGE) in REPORTING for w in before[-3:-1])
    return (opened and closed) or (reported and opened)


def words_of(text: str | None) -> list[str]:
    """The lower-cased words in order; a word in a script without spaces as its windows."""
    text = (text or "").lower()
    words = text.split()
    if text.isascii() or not UNSPACED.search(text):
        return words
    return [part for word in words for part in (windows_of(word) if UNSPACED.search(word) else (word,))]


def windows_of(word: str):
    word = word.strip(EDGE)
    return [word[i:i + UNSPACED_WINDOW] for i in range(max(1, len(word) - 1))] or [word]


def word_terms(word: str):
    """The exact word (if it is not too long) and its stems, as terms: a trailing ``$`` marks an exact word."""
    word = word.strip(EDGE)
    if UNSPACED.search(word):
        yield from (word[:n] for n in range(2, len(word) + 1))
    elif len(word) >= WORD_LENGTHS.start and not word.isdigit():
        if len(word) in WORD_LENGTHS:
            yield word + "$"
        for n in STEM:
            if n <= len(word):
                yield word[:n]


def _terms_of(text: str | None) -> set[str]:
    return {t for w in set(words_of(text)) for t in word_terms(w)}


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
            train) -> tuple[DataFrame, list[int], list[int]]:
    """At most ``SAMPLE`` training rows of each class, one a labelled id, and each class's ids in all and in the sample."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & train(F.col(id_col)))
             .groupBy(F.col(id_col).cast("bigint").alias("__llm_id")).agg(F.max(label_col).cast("int").alias("toxic")))
    known = materialise(known, "toxic-known")
    ranked = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("__llm_id", F.lit(11)), "__llm_id").limit(SAMPLE) for y in (0, 1)]
    picked = materialise(ranked[0].union(ranked[1]), "toxic-picked")
    texts = docs.select(F.col(id_col).cast("bigint").alias("__llm_id"), F.col(text_col).cast("string").alias("text"))
    # An id that several rows share has one of their texts, so copies never reach the driver: at most 2 * SAMPLE rows do.
    size = F.coalesce(F.length("text"), F.lit(0)).alias("size")
    keyed = texts.join(F.broadcast(picked), "__llm_id").select("__llm_id", "toxic", F.xxhash64("text").alias("h"), size)
    one = keyed.groupBy("__llm_id", "toxic").agg(F.min(F.struct("h", "size")).alias("m"))
    rows = one.select("__llm_id", "toxic", "m.h", "m.size", F.xxhash64("__llm_id", F.lit(11)).alias("place")).collect()
    chosen, room = [], [SAMPLE_CHARS, SAMPLE_CHARS]
    for r in sorted(rows, key=lambda r: (r["place"], r["__llm_id"])):
        if room[r["toxic"]] > 0:
            chosen.append((r["__llm_id"], r["toxic"], r["h"]))
            room[r["toxic"]] -= r["size"]
    chosen = docs.sparkSession.createDataFrame(chosen, "__llm_id bigint, toxic int, h bigint")
    found = texts.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["__llm_id", "h"])
    sample = materialise(found.select("__llm_id", "text", "toxic"), "toxic-sample")
    if sample.count() > chosen.count():  # copies of id and text
        sample = materialise(sample.dropDuplicates(["__llm_id"]), "toxic-sample")
    count = lambda df: [{r[0]: r[1] for r in df.groupBy("toxic").count().collect()}.get(y, 0) for y in (0, 1)]
    return sample, count(known), count(sample)


def _learn_terms(sample: DataFrame, ratio: float, least: int) -> list[tuple[str, bool, float]]:
    """Terms of toxic documents, greedily by the toxic documents not yet explained ``COVER`` times."""

    def count(batches):
        seen = (Counter(), Counter())

        def flush(y):
            names, n = list(seen[y]), np.fromiter(seen[y].values(), np.int64, len(seen[y]))
            seen[y].clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(n * (1 - y)), pa.array(n * y)],
                                              ["term", "clean", "toxic"])

        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                seen[y].update(_terms_of(text.as_py()))
                if len(seen[y]) > 1 << 17:
                    yield flush(y)
        yield flush(0)
        yield flush(1)

    counts = (sample.select("text", "toxic").mapInArrow(count, "term string, clean bigint, toxic bigint")
              .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
              .where(F.col("toxic") >= least)
              .withColumn("share", F.col("toxic") / (F.col("toxic") + F.col("clean") * ratio + 0.25))
              .where("share >= 0.6"))
    counts = materialise(counts, "toxic-candidates")
    # Candidates occur in toxic sample rows, whose number and characters are bounded.
    candidates = {r["term"]: r for r in counts.collect()}

    def spell(batches):
        for batch in batches:
            terms = [sorted(_terms_of(text.as_py())) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.string()))], ["doc", "terms"])

    toxic = sample.where("toxic = 1").select("__llm_id", "text").mapInArrow(spell, "doc bigint, terms array<string>")
    pairs = toxic.select("doc", F.explode("terms").alias("term")).join(counts.select("term"), "term", "left_semi")
    explained: dict[str, set[int]] = {t: set() for t in candidates}
    for r in pairs.groupBy("doc").agg(F.collect_list("term").alias("terms")).toLocalIterator():  # a row a toxic sample row
        for t in r["terms"]:
            explained[t].add(r["doc"])
    chosen: list[tuple[str, bool, float]] = []
    stems: set[str] = set()
    times: Counter = Counter()

    def rank(term, gain):
        # Ties go to the purer term, then to whole words, then to the longer term.
        share = candidates[term]["share"]
        return -gain * share ** 2, -share, not term.endswith("$"), -len(term), term, gain

    heap = [rank(t, len(d)) for t, d in explained.items()]
    heapq.heapify(heap)
    while heap:
        *_, term, gain = heapq.heappop(heap)
        new = [d for d in explained[term] if times[d] < COVER]
        word = term.rstrip("$")
        if len(new) < least or any(word[:n] in stems for n in range(1, len(word) + 1)):
            continue  # too few, or a chosen stem already matches it
        if len(new) < gain:
            heapq.heappush(heap, rank(term, len(new)))
            continue
        r = candidates[term]
        if not term.endswith("$"):
            stems.add(word)
        chosen.append((word, not term.endswith("$"), round(math.log((r["toxic"] + 0.5) / (r["clean"] * ratio + 0.5)), 4)))
        times.update(new)
    return chosen


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[float]:
    """Logistic weights (the last is the intercept) by Newton's method with a ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), 0.3)
    ridge[-1] = 1e-3
    for _ in range(40):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def _matcher(model: dict) -> Cache:
    lexicon = Lexicon(model["terms"])
    return Cache(lambda word: lexicon.match(word.strip(EDGE)), 1 << 17)


def train_toxicity(docs: DataFrame, labels: DataFrame, train=None, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic", least: int = 3) -> dict:
    """The model: terms (text, stem or word, weight) and logistic weights.

    ``train`` tells from an id column which labelled rows may be learned from
    (default: all). Labels other than 0 and 1, and null ids, are passed over; ids
    labelled twice take the larger label. With no toxic or no clean row to learn
    from, no term is learned and every score is the share of toxic rows.
    """
    train = train or (lambda c: F.lit(True))
    sample, known, picked = _sample(docs, labels, id_col, text_col, label_col, train)
    if not picked[0] or not picked[1]:
        share = (known[1] + 0.5) / (sum(known) + 1.0) if any(known) else 0.0
        return {"key": uuid.uuid4().hex, "terms": [], "weights": None, "share": min(share, 1.0)}
    scale = [known[y] / picked[y] for y in (0, 1)]
    terms = _learn_terms(sample, scale[0] / scale[1], least)
    model = {"key": uuid.uuid4().hex, "terms": terms, "weights": None, "share": 0.0}

    def extract(batches):
        match = worker_state(("toxic-words", model["key"]), lambda: _matcher(model))
        for batch in batches:
            rows = [features(t.as_py(), match) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"])

    rows = sample.select("text", "toxic").mapInArrow(extract, "x array<double>, toxic int").collect()  # bounded by SAMPLE
    x, y = np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], float)
    # One more clean row without matches: with hardly any labels, a text that shows nothing is presumed clean.
    model["weights"] = _fit(np.vstack([x, np.zeros(x.shape[1])]), np.append(y, 0.0),
                            np.append(np.where(y == 1, scale[1], scale[0]), 1.0))
    return model


def score_toxicity(docs: DataFrame, model: dict, text_col: str = "text", score_col: str = "__llm_toxic") -> DataFrame:
    """The documents with all their columns and a score from 0 to 1; a null text is empty."""
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches):
        match = worker_state(("toxic-words", model["key"]), lambda: _matcher(model))
        weights = np.array(model["weights"]) if model["weights"] else None
        for batch in batches:
            if weights is None:
                scores = np.full(batch.num_rows, model["share"])
            else:
                x = np.array([features(t.as_py(), match) for t in batch.column(at)]).reshape(batch.num_rows, -1)
                scores = 1.0 / (1.0 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, score_col])

    return docs.mapInArrow(run, schema)
