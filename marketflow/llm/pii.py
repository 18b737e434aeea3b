"""Personal data: spans by fixed rules, and further ones from a linear-chain conditional random field.

The rules find e-mail addresses, IP addresses, card and phone numbers in their plain
forms. The field finds those written in other ways ("jo at mail dot example dot
com", "10[.]1[.]2[.]3", "(555) 010 0199"): a text is cut into tokens (letters,
digits, white space, single signs), each token has features of its shape and its neighbours'
shapes, and the most likely sequence of labels is found by the Viterbi recursion
over many stretches of tokens at a time. Words far from any digit, ``@``, ``dot``
or inner full stop can only be labelled "none", so just the stretches around those
are decoded; each is decoded as a whole, however long. Spans of the field that touch
one of the rules, or lack what their kind must have (``plausible``), are left out.
The field is trained on a small labelled table, by default made by
``example_rows`` from a list of forms.
"""

from __future__ import annotations

import random
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *(f"{b}-{k}" for k in KINDS for b in "BI"))
SAMPLE = 4096  # labelled rows at most that a field is trained on
REACH = 5  # words on both sides of a trigger's word that are decoded with it
BATCH = 512  # stretches decoded side by side
_SPAN = "struct<kind:string,start:bigint,end:bigint,found_by:string>"
_SPAN_TYPE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("found_by", pa.string())])

# ------------------------------------------------------------------ rules

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match can only begin where no digit stands before it, so long numbers are read once.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, from each ``@`` outward (linear in the text)."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            out.append((start, done))
        at = text.find("@", at + 1)
    return out


def rule_spans(text: str) -> list[tuple[str, int, int]]:
    """``kind, start, end`` (code points, end exclusive) by kind, then start."""
    out = [("email", s, e) for s, e in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.groups()):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# --------------------------------------------------------------- features

TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.S)
TRIGGER = re.compile(r"[0-9@]|\bdot\b|\bDOT\b|\bDot\b|(?<=[^\W\d_])\.(?=[^\W\d_])")
_HASH = 1 << 14


def shape(token: str) -> str:
    """What kind of token it is: letters by case and length, digits by length and size, other signs as they are."""
    if token[0] in "0123456789":
        size = len(token)
        if size > 4:
            return "9" * min(size, 20)
        return "9" * size + ("b" if size == 3 and int(token) <= 255 else "")
    if token[0].isalpha():
        low = token.lower()
        if low in WORDS:
            return low
        case = "X" if token.isupper() and len(token) > 1 else "Xx" if token[0].isupper() else "x"
        return case + str(min(len(token), 4))
    return " " if token.isspace() and "\n" not in token else "\n" if token.isspace() else token


# Fixed words that tell written-out addresses and numbers from ordinary text.
WORDS = frozenset({"at", "dot", "com", "net", "org", "edu", "io", "page", "v", "http", "https", "www", "order", "id",
                   "password", "the"})


@lru_cache(1 << 16)
def _shape_number(token: str) -> int:
    return zlib.crc32(shape(token).encode("utf-8", "surrogatepass"))


# Which neighbours' shapes (by distance) make a feature together.
_WINDOWS = ((0,), (-1,), (1,), (-2,), (2,), (-1, 0), (0, 1), (-2, -1, 0), (0, 1, 2), (-1, 0, 1), (-3, -2, -1, 0), (0, 1, 2, 3))


def features(tokens: list[str]) -> np.ndarray:
    """One row of feature numbers per token: its shape, shapes around it, and up to four of them in a row."""
    numbers = np.zeros(len(tokens) + 6, np.uint64)  # 0: outside the stretch
    numbers[3:-3] = [_shape_number(t if len(t) <= 32 else t[:1] * 32) for t in tokens]
    out = np.empty((len(tokens), len(_WINDOWS)), np.int32)
    for column, window in enumerate(_WINDOWS):
        x = np.full(len(tokens), column + 1, np.uint64)
        for distance in window:
            x = (x ^ numbers[3 + distance:3 + distance + len(tokens)]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(31)
        out[:, column] = x % np.uint64(_HASH)
    return out


# ------------------------------------------------------------------ field


@dataclass(frozen=True)
class Field:
    """Weights by feature and label, and of label pairs (``-inf`` where one can't follow the other)."""

    emit: np.ndarray
    step: np.ndarray


def _may_follow() -> np.ndarray:
    """``I`` of a kind follows ``B`` or ``I`` of it, and nothing else; a stretch begins behind "none"."""
    ok = np.ones((len(LABELS), len(LABELS)), bool)
    for j, label in enumerate(LABELS):
        if label[0] == "I":
            ok[:, j] = [other[1:] == label[1:] and other != "none" for other in LABELS]
    return ok


def _scores(field_emit: np.ndarray, feats: np.ndarray) -> np.ndarray:
    return field_emit[feats].sum(-2)


def viterbi(scores: np.ndarray, lengths: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The best labels of several sequences at once: ``scores`` is (sequence, place, label), padded to the longest."""
    n, places, k = scores.shape
    best = np.full((n, k), -np.inf)
    best[:, 0] = 0.0  # each sequence begins behind "none"
    came = np.zeros((n, places, k), np.int8)
    rows = np.arange(n)
    last = np.zeros(n, np.int64)
    for t in range(places):
        ways = best[:, :, None] + step[None]
        came[:, t] = ways.argmax(1)
        best = ways.max(1) + scores[:, t]
        done = lengths == t + 1
        if done.any():
            last[done] = best[done].argmax(1)
    out = np.zeros((n, places), np.int8)
    label = last.copy()
    for t in range(places - 1, -1, -1):
        on = t < lengths
        out[on, t] = label[on]
        label[on] = came[rows[on], t, label[on]]
    return out


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):  # no way at all: -inf
        return np.log(np.exp(a - top).sum(axis)) + top.squeeze(axis)


def _gradient(emit, step, feats, labels, lengths):
    """Log-likelihood of padded sequences and its gradient, by the forward and backward recursions."""
    n, places = labels.shape
    k = len(LABELS)
    scores = _scores(emit, feats)
    alpha = np.empty((n, places + 1, k))
    alpha[:, 0] = -np.inf
    alpha[:, 0, 0] = 0.0
    for t in range(places):
        alpha[:, t + 1] = _logsum(alpha[:, t, :, None] + step[None], 1) + scores[:, t]
    beta = np.zeros((n, places + 1, k))
    for t in range(places - 1, -1, -1):
        further = _logsum(step[None] + (scores[:, t] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where((t < lengths)[:, None], further, 0.0)
    total = _logsum(alpha[np.arange(n), lengths], 1)
    inside = np.arange(places)[None] < lengths[:, None]
    g_emit, g_step = np.zeros_like(emit), np.zeros((k, k))
    before = np.concatenate([np.zeros((n, 1), labels.dtype), labels[:, :-1]], 1)
    hit = inside.nonzero()
    np.add.at(g_step, (before[hit], labels[hit]), 1.0)
    fit = scores[hit[0], hit[1], labels[hit]].sum() + step[before[hit], labels[hit]].sum() - total.sum()
    one = np.zeros((len(hit[0]), k))
    one[np.arange(len(one)), labels[hit]] = 1.0
    one -= np.exp(alpha[hit[0], hit[1] + 1] + beta[hit[0], hit[1] + 1] - total[hit[0]][:, None])
    cells = feats[hit][:, :, None].astype(np.int64) * k + np.arange(k)
    g_emit += np.bincount(cells.ravel(), np.broadcast_to(one[:, None, :], cells.shape).ravel(), emit.size).reshape(emit.shape)
    for t in range(places):
        on = t < lengths
        both = alpha[on, t, :, None] + step[None] + (scores[on, t] + beta[on, t + 1])[:, None, :] - total[on][:, None, None]
        g_step -= np.exp(both).sum(0)
    return fit, g_emit, g_step


def fit_field(sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = 15, rate: float = 0.15,
              decay: float = 1e-3, seed: int = 5) -> Field:
    """Weights by gradient steps of adapted size (Adam) on batches of sequences of like length."""
    k = len(LABELS)
    free = _may_follow()
    emit, step = np.zeros((_HASH, k)), np.where(free, 0.0, -np.inf)
    moments = [[np.zeros_like(emit), np.zeros_like(emit)], [np.zeros((k, k)), np.zeros((k, k))]]
    ordered = sorted((s for s in sequences if len(s[1])), key=lambda s: len(s[1]))
    batches = []
    for i in range(0, len(ordered), 64):
        part = ordered[i:i + 64]
        lengths = np.array([len(y) for _, y in part])
        feats = np.zeros((len(part), lengths.max(), part[0][0].shape[1]), np.int32)
        labels = np.zeros((len(part), lengths.max()), np.int64)
        for row, (x, y) in enumerate(part):
            feats[row, :len(y)], labels[row, :len(y)] = x, y
        batches.append((feats, labels, lengths))
    rng, t = random.Random(seed), 0
    for _ in range(rounds):
        rng.shuffle(batches)
        for feats, labels, lengths in batches:
            t += 1
            _, g_emit, g_step = _gradient(emit, step, feats, labels, lengths)
            for value, grad, (m, v) in ((emit, g_emit / len(labels) - decay * emit, moments[0]),
                                        (step, np.where(free, g_step, 0.0) / len(labels), moments[1])):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                move = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
                value += np.where(np.isfinite(value), move, 0.0)
    return Field(emit.astype(np.float32), step.astype(np.float32))


# --------------------------------------------------------------- labelled table

# How personal data may be written. #: a digit, ~: a number up to 255, w: a word, W: a capitalised one.
FORMS = {
    "email": ("w at w dot com", "w dot w at w dot org", "w (at) w (dot) com", "w [at] w [dot] net", "w@w dot com", "w [at] w.com",
              "w AT w DOT com", "w[at]w[dot]org", "w(at)w.com", "w.w (at) w.net", "w @ w.com", "w## at w dot edu", "w_w at w dot io",
              "w.##@w# dot w dot com", "w at w dot w dot org"),
    "ip": ("~[.]~[.]~[.]~", "~ . ~ . ~ . ~", "~(.)~(.)~(.)~", "~ dot ~ dot ~ dot ~", "~,~,~,~", "~[dot]~[dot]~[dot]~"),
    "card": ("####.####.####.####", "####_####_####_####", "####/####/####/####", "################", "####  ####  ####  ####",
             "#### ###### #####", "####-######-#####"),
    "phone": ("+# (###) ###-####", "(###) ###-####", "###-###-####", "(###) ### ####", "### ### ####", "###.###.####", "00## ### #######", "1-###-###-####",
              "(0##) #### ####", "0### ### ####", "00 ## ### ### ####"),
}
# Texts with digits, full stops or "dot" that are no personal data.
OTHERS = ("####-##-##", "##:##", "##:##:##", "##/##/####", "$#,###", "#.##", "##.##%", "#.#.#", "v#.##.#", "##############", "##########",
          "password=#w##w###w##", "page ##", "w.w", "https://w.w.com/w/###?w=#", "(####)", "### w", "#w", "order ########", "id ######",
          "w dot w", "the dot w", "w at ##", "w at the w", "#,###,###", "## w ## w", "##-##", "w at ##:##", "#### w", "w #", "w ##.",
          "############", "w at w", "w#.w", "w at w.com", "w.w at w.net", "w at w. W", "w. W at w.", "## ##", "#### ####", "w. W w", "w (##) w", "[##]", "####", "##th", "w.w(#)", "w_##", "#######",
          "www.w.org", "w at w. W", "###", "##.##.####", "+##", "#####-####")


def _written(form: str, rng: random.Random) -> str:
    out = []
    for sign in re.findall(r"(?<![A-Za-z])[wW](?![A-Za-z])|[#~]|.", form, re.S):
        if sign == "#":
            out.append(str(rng.randrange(10)))
        elif sign == "~":
            out.append(str(rng.randrange(256)))
        elif sign in ("w", "W"):
            word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzéüñ") for _ in range(rng.choice((2, 3, 4, 5, 6, 7, 9))))
            out.append(word.capitalize() if sign == "W" or rng.random() < 0.1 else word)
        else:
            out.append(sign)
    return "".join(out)


def _valued(kind: str, rng: random.Random) -> str:
    """One value of a kind; a card's last digit is the one that its check asks for."""
    text = _written(rng.choice(FORMS[kind]), rng)
    while kind == "card" and not luhn("".join(_DIGIT.findall(text))):
        text = text[:-1] + str((int(text[-1]) + 1) % 10)
    return text


def example_rows(count: int = 2400, seed: int = 11) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """``text, spans`` made from ``FORMS`` and ``OTHERS`` between random words, equal for equal arguments.

    Half of the rows hold one form of personal data (the kinds in turn); all hold others.
    """
    rng, rows = random.Random(seed), []
    for i in range(count):
        parts = [(None, _written(rng.choice(OTHERS), rng)) for _ in range(rng.randint(0, 2))]
        if i % 2 == 0:
            kind = KINDS[i // 2 % len(KINDS)]
            parts.insert(rng.randint(0, len(parts)), (kind, _valued(kind, rng)))
        text, spans = "", []
        for kind, part in [*parts, (None, "")]:
            words = " ".join(_written("w", rng) for _ in range(rng.randint(1, 6)))
            text += words + rng.choice((" ", " ", " ", ", ", ": ", ". ", "\n"))
            if kind:
                spans.append((kind, len(text), len(text) + len(part)))
            text += part + rng.choice((" ", " ", ". ", ", ", "\n")) if part else ""
            if kind and rng.random() < 0.2:  # two in a row
                kind = rng.choice(KINDS)
                part = _valued(kind, rng)
                spans.append((kind, len(text), len(text) + len(part)))
                text += part + " "
        rows.append((text, spans))
    return rows


def labelled_table(spark: SparkSession, count: int = 2400, seed: int = 11) -> DataFrame:
    """``text, spans`` (``kind, start, end``) of ``example_rows``."""
    return spark.createDataFrame(example_rows(count, seed), "text string, spans array<struct<kind:string,start:bigint,end:bigint>>")


def train_pii(labelled: DataFrame, seed: int = 5) -> Field:
    """The field learned from a table ``text, spans``: at most ``SAMPLE`` rows, chosen by hash of the text.

    Rows without text and spans of other kinds or outside the text are left out, null
    spans count as none; repeated rows count once; from no rows at all comes a field
    that finds nothing.
    """
    some = labelled.where("text is not null").select("text", "spans").dropDuplicates(["text"])
    rows = some.orderBy(F.xxhash64("text"), "text").limit(SAMPLE).collect()
    return fit_field([encode_example(r["text"], r["spans"] or []) for r in rows], seed=seed)


def encode_example(text: str, spans) -> tuple[np.ndarray, np.ndarray]:
    cuts = [m.span() for m in TOKEN.finditer(text)]
    labels = np.zeros(len(cuts), np.int64)
    for kind, start, end in (tuple(s) for s in spans):
        if kind in KINDS:
            inside = [i for i, (a, b) in enumerate(cuts) if a >= start and b <= end]
            for nth, i in enumerate(inside):
                labels[i] = LABELS.index(f"{'I' if nth else 'B'}-{kind}")
    return features([text[a:b] for a, b in cuts]), labels


# ----------------------------------------------------------------- decoding


def stretches(text: str):
    """``[(start, end), ...]`` of the tokens of all words within ``REACH`` words of a trigger, one list per stretch."""
    hits = [m.start() for m in TRIGGER.finditer(text)]
    if not hits:
        return
    words = np.array([m.span() for m in _WORD.finditer(text)])
    near = np.zeros(len(words) + 1, np.int64)
    at = np.searchsorted(words[:, 0], np.array(hits), "right") - 1
    np.add.at(near, np.maximum(at - REACH, 0), 1)
    np.add.at(near, np.minimum(at + REACH + 1, len(words)), -1)
    inside = np.concatenate([[False], np.cumsum(near)[:-1] > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    for first, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        yield [m.span() for m in TOKEN.finditer(text, int(words[first, 0]), int(words[end - 1, 1]))]


_WORD = re.compile(r"\S+")


# Digits a span of the field must have, at least and at most.
_NEEDS = {"email": (0, 12), "ip": (4, 12), "card": (15, 19), "phone": (10, 15)}
_EMAIL = re.compile(r"[\w.%+()\[\]\s-]{1,64}?(?:@|\bat\b)(?:[\w()\[\]\s-]{1,64}?(?:\.|\bdot\b))+[()\[\]\s]*[^\W\d_]{2,6}", re.I)
_SPELT = re.compile(r"@|\bdot\b|[(\[]\s*at\s*[)\]]", re.I)


def plausible(kind: str, piece: str) -> bool:
    """Whether a span of the field holds what its kind must have (a check value, parts, an end of a host name)."""
    digits = _DIGIT.findall(piece)
    low, high = _NEEDS[kind]
    if not low <= len(digits) <= high:
        return False
    if kind == "email":
        return len(piece) <= 256 and bool(_SPELT.search(piece)) and bool(_EMAIL.fullmatch(piece))
    if any(c.isalpha() for c in (re.sub(r"\bdot\b", "", piece, flags=re.I) if kind == "ip" else piece)):
        return False
    if kind == "card":
        return luhn("".join(digits))
    if kind == "ip":
        parts = re.findall("[0-9]+", piece)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return True


class Decoder:
    """Field spans of many texts at a time."""

    def __init__(self, field: Field):
        self.field = field

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        out: list[list] = [[] for _ in texts]
        wait = []
        for i, text in enumerate(texts):
            for tokens in stretches(text):
                wait.append((i, tokens))
        wait.sort(key=lambda s: len(s[1]))  # like lengths side by side
        at = 0
        while at < len(wait):
            # Fewer side by side the longer they are, so the padded scores stay bounded.
            end = min(len(wait), at + BATCH)
            while end > at + 1 and (end - at) * len(wait[end - 1][1]) > BATCH * 256:
                end -= max(1, (end - at) // 4)
            self._decode(texts, wait[at:end], out)
            at = end
        return [sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])) for spans in out]

    def _decode(self, texts, part, out) -> None:
        lengths = np.array([len(t) for _, t in part])
        scores = np.zeros((len(part), lengths.max(), len(LABELS)), np.float32)
        for row, (i, tokens) in enumerate(part):
            scores[row, :len(tokens)] = _scores(self.field.emit, features([texts[i][a:b] for a, b in tokens]))
        for (i, tokens), labels, n in zip(part, viterbi(scores, lengths, self.field.step), lengths):
            marked = np.flatnonzero(labels[:n])
            begins = [int(t) for t in marked if LABELS[labels[t]][0] == "B"]
            for t in begins:
                kind, last = LABELS[labels[t]][2:], t
                while last + 1 < n and labels[last + 1] == labels[t] + 1:
                    last += 1
                while last > t and texts[i][tokens[last][0]].isspace():
                    last -= 1
                start, end = tokens[t][0], tokens[last][1]
                if plausible(kind, texts[i][start:end]):
                    out[i].append((kind, start, end))


def _apart(added: list, rules: list) -> list:
    """The field's spans that touch no span of the rules."""
    taken = sorted((s, e) for _, s, e in rules)
    starts = [s for s, _ in taken]
    far = np.maximum.accumulate([e for _, e in taken]) if taken else []
    out = []
    for kind, start, end in added:
        i = int(np.searchsorted(starts, end)) if taken else 0
        if i == 0 or far[i - 1] <= start:
            out.append((kind, start, end))
    return out


def find_pii(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``spans``, an array of ``kind, start, end, found_by``.

    Offsets are code points, the end exclusive; ``found_by`` is ``rule`` or ``field``.
    Spans are ordered by kind (``KINDS``), then start. All spans of the rules are
    there, per kind leftmost and non-overlapping (two kinds may overlap); the
    field's touch none of them. A null text counts as empty and has no spans; rows
    that repeat an id or have none each give their row; an empty table gives no
    rows; further columns are ignored. Texts are read whole.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(field)  # _HASH rows of weights: a fixed size

    def run(batches):
        decoder = Decoder(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            by_rule = [rule_spans(t) for t in texts]
            spans = []
            for rules, added in zip(by_rule, decoder.spans(texts)):
                both = [(*s, "rule") for s in rules] + [(*s, "field") for s in _apart(added, rules)]
                both.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
                spans.append([dict(zip(("kind", "start", "end", "found_by"), s)) for s in both])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(_SPAN_TYPE))], ["doc_id", "spans"])

    return rows.mapInArrow(run, f"doc_id bigint, spans array<{_SPAN}>")
