"""Language identification by interpolated Kneser-Ney models of characters.

One model per language, of order ``ORDER``. Counting runs over all training
texts: every task reduces its texts to counted n-grams of the highest order, one
aggregate sums them by (language, n-gram), and the Kneser-Ney counts of the lower
orders are the numbers of distinct n-grams that end in each shorter one. Every
n-gram is kept, in sorted arrays of 64-bit keys, with the interpolated probability in
each language that saw it, and its back-off weight where the key is a context: the
size follows the n-grams seen, not their number times that of languages. The arrays are cut
into parts of about ``CELLS`` numbers by the two characters before the last:
all n-grams of such a context and all that they back off to lie in one part, so a
part is a whole model of the n-grams in its range. Texts are scored by every part,
and the parts' sums added up. A text goes to the language of least cross-entropy
per character. Entropies beyond what training texts of the language show are
marked as rejected, by the quantile over all those texts.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import materialise, worker_state

ORDER = 4
CELLS = 1 << 21  # numbers in a part of the model, about: what a worker holds at once
_NUMBERS = 3  # of an n-gram in a language that saw it: key, language, probability
TOP = 1 << 22  # log probabilities of frequent n-grams held ready, in every language
BINS = 1 << 12  # of a unit of entropy: the training texts of a language are counted by these, and read in the bins that the quantile lies in
REJECT = 0.999  # the quantile of a language's own entropies beyond which a text is rejected
UNKNOWN = "und"
DISCOUNT = 0.75
ALPHABET = 1 << 16  # a character is a 16-bit unit: code points above U+FFFF are two of them
SURE = 40  # characters of evidence that a score may rest on
_AT_ONCE = 1 << 22
_HELD = 1 << 22  # numbers of a block of rows by languages
_END = 1 << 32  # beyond the last cell


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _units(lowered: str) -> np.ndarray:
    """UTF-16 units of a lower-cased text; whatever is neither a-z nor above U+00A9 is a space."""
    units = np.frombuffer(lowered.encode("utf-16-le", "surrogatepass"), np.uint16)
    return np.where((units >= 97) & (units <= 122) | (units >= 0xAA), units, 32).astype(np.uint64)


def _unspaced(units: np.ndarray, last: int) -> np.ndarray:
    """Runs of spaces as one; ``last`` is the unit before."""
    before = np.concatenate([[last], units[:-1]])
    return units[(units != 32) | (before != 32)]


def codes(text: str) -> np.ndarray:
    """The units of a text between two spaces, runs of spaces as one."""
    return np.concatenate([[np.uint64(32)], _unspaced(np.append(_units(text.lower()), np.uint64(32)), 32)])


def grams(units: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The key of the ``ORDER`` units that end at each place; ``before`` holds the ``ORDER - 1`` units ahead of the first."""
    key = np.zeros(len(units), np.uint64)
    padded = np.concatenate([before, units])
    for i in range(ORDER):
        key = key << np.uint64(16) | padded[i:i + len(units)]
    return key


def chunks(text: str):
    """A text's keys, a bounded number at a time; what stands before a cut is carried over, so each counts once."""
    lowered, before = text.lower(), np.full(ORDER - 1, 32, np.uint64)
    for at in range(0, len(lowered) + 1, _AT_ONCE):
        units = _units(lowered[at:at + _AT_ONCE])
        if at + _AT_ONCE > len(lowered):
            units = np.append(units, np.uint64(32))
        units = _unspaced(units, int(before[-1]))
        yield grams(units, before)
        before = np.concatenate([before, units])[-(ORDER - 1):]


def _tail(n: int) -> np.uint64:
    return np.uint64((1 << 16 * n) - 1)


def count_grams(texts: DataFrame) -> DataFrame:
    """``lang, key, n`` over all rows of ``(lang, text)``."""

    def run(batches):
        held: dict[str, list] = {}
        size: dict[str, int] = {}

        def flush(lang):
            keys, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
            size.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)],
                                              ["lang", "key", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for keys in chunks(text.as_py()):
                    held.setdefault(lang, []).append(keys)
                    size[lang] = size.get(lang, 0) + len(keys)
                    if size[lang] > 1 << 20:
                        yield flush(lang)
        for lang in list(held):
            yield flush(lang)

    counted = texts.mapInArrow(run, "lang string, key bigint, n bigint")
    return counted.groupBy("lang", "key").agg(F.sum("n").alias("n"))


class Pairs:
    """Values of (key, language) pairs: the sorted keys, and of each the languages that have it, in order."""

    def __init__(self, keys: np.ndarray, lang: np.ndarray, values: np.ndarray):
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.start = keys[first], np.append(first, len(keys))
        self.lang, self.values = lang.astype(np.int32), values

    def rows(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every pair of the given keys: the place of the key among them, the language, the value."""
        at, found = _find(self.keys, keys)
        place, first = np.flatnonzero(found), self.start[at[found]]
        size = self.start[at[found] + 1] - first
        entry = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
        return np.repeat(place, size), self.lang[entry], self.values[entry]

    def of(self, keys: np.ndarray, lang: np.ndarray, langs: int) -> tuple[np.ndarray, np.ndarray]:
        """Per given pair the place of its value, and whether there is one."""
        at, found = _find(self.keys, keys)
        number = np.repeat(np.arange(len(self.keys)), np.diff(self.start)) * langs + self.lang
        place, same = _find(number, at * langs + lang)
        return place, found & same


class Tables:
    """Per order the probabilities of n-grams and the back-off weights of contexts, for the languages that saw them.

    Nothing is held of an n-gram in a language without it. The full-order n-grams
    most often seen have every language's log probability beside them, as many as
    make ``TOP`` numbers; others are put together from the pairs when looked up,
    with the same result.
    """

    def __init__(self, counts: list[dict[str, tuple[np.ndarray, np.ndarray]]], langs: list[str]):
        self.langs = langs
        self.own, self.backoff = [], []
        for n, by_lang in enumerate(counts, 1):
            some = [(at, *by_lang[lang]) for at, lang in enumerate(langs) if lang in by_lang]
            lang = np.concatenate([np.zeros(0, np.int64), *[np.full(len(keys), at) for at, keys, _ in some]])
            key = np.concatenate([np.zeros(0, np.uint64), *[keys for _, keys, _ in some]])
            count = np.concatenate([np.zeros(0), *[seen for _, _, seen in some]])
            order = np.lexsort((lang, key))
            lang, key, count = lang[order], key[order], count[order]
            contexts, context = np.unique(key >> np.uint64(16), return_inverse=True)
            pairs, which = np.unique(context * len(langs) + lang, return_inverse=True)
            total = np.bincount(which, count, len(pairs))
            weight = DISCOUNT * np.bincount(which, minlength=len(pairs)) / total
            below = self._of_pairs(key & _tail(n - 1), lang, n - 1)
            self.backoff.append(Pairs(contexts[pairs // len(langs)], pairs % len(langs), weight))
            self.own.append(Pairs(key, lang, (count - DISCOUNT) / total[which] + weight[which] * below))
        full, room = self.own[-1], max(1, TOP // max(1, len(langs)))
        self.frequent = full.keys
        if len(full.keys) > room:
            seen = np.add.reduceat(count, full.start[:-1])
            self.frequent = full.keys[np.sort(np.argpartition(-seen, room)[:room])]
        self.top = np.concatenate([np.zeros((0, len(langs)), np.float32),
                                   *[self._logs(self.frequent[part]) for part in self._blocks(len(self.frequent))]])

    def pairs(self) -> int:
        """How many (n-gram, language) and (context, language) pairs there are."""
        return sum(len(table.values) for table in self.own + self.backoff)

    def _blocks(self, n: int):
        """Slices of ``n`` rows with a number for each language, so that a bounded part is held."""
        step = max(1, _HELD // max(1, len(self.langs)))
        return [slice(at, at + step) for at in range(0, n, step)]

    def _of_pairs(self, keys: np.ndarray, lang: np.ndarray, n: int) -> np.ndarray:
        """Interpolated probability of the last of ``n`` characters after the others, in one language for each key."""
        p = np.full(len(keys), 1.0 / ALPHABET)
        for k in range(1, n + 1):
            part = keys & _tail(k)
            at, found = self.backoff[k - 1].of(part >> np.uint64(16), lang, len(self.langs))
            p[found] *= self.backoff[k - 1].values[at[found]]
            at, found = self.own[k - 1].of(part, lang, len(self.langs))
            p[found] = self.own[k - 1].values[at[found]]
        return p

    def probability(self, keys: np.ndarray, n: int) -> np.ndarray:
        """Interpolated probability of the last of ``n`` characters after the others, per language."""
        p = np.full((len(keys), len(self.langs)), 1.0 / ALPHABET)
        for k in range(1, n + 1):
            part = keys & _tail(k)
            place, lang, weight = self.backoff[k - 1].rows(part >> np.uint64(16))
            p[place, lang] *= weight
            place, lang, own = self.own[k - 1].rows(part)
            p[place, lang] = own
        return p

    def _logs(self, keys: np.ndarray) -> np.ndarray:
        return np.log(self.probability(keys, ORDER)).astype(np.float32)

    def losses(self, text: str, start: int = 0, end: int = _END) -> tuple[np.ndarray, int]:
        """Summed log losses in each language of the characters whose cell lies in a range, and their number."""
        total, size = np.zeros(len(self.langs)), 0
        for keys in chunks(text):
            if (start, end) != (0, _END):
                cell = keys & np.uint64(0xFFFF0000) | keys >> np.uint64(32) & np.uint64(0xFFFF)
                keys = keys[(cell >= start) & (cell < end)]
            at, found = _find(self.frequent, keys)
            known = at[found]
            for part in self._blocks(len(known)):
                total -= self.top[known[part]].sum(axis=0, dtype=np.float64)
            if len(known) < len(keys):
                other, times = np.unique(keys[~found], return_counts=True)
                for part in self._blocks(len(other)):
                    total -= times[part] @ self._logs(other[part]).astype(np.float64)
            size += len(keys)
        return total, size

    def entropies(self, text: str) -> tuple[np.ndarray, int]:
        """Cross-entropy per character in each language, and the characters."""
        total, size = self.losses(text)
        return total / max(1, size), size


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def _cell() -> Column:
    """The two characters before an n-gram's last: the nearer one, then the one before it."""
    key = F.col("key")
    return key.bitwiseAND(F.lit(0xFFFF0000)).bitwiseOR(F.shiftright(key, 32).bitwiseAND(F.lit(0xFFFF)))


def _ranges(counts: list[DataFrame]) -> list[tuple[int, int]]:
    """Ranges of cells that cover all of them, each with about ``CELLS`` numbers."""
    parts = max(1, math.ceil(_NUMBERS * sum(c.count() for c in counts[2:]) / CELLS))
    cuts = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        cuts = counts[-1].agg(F.percentile_approx(_cell(), shares, max(10_000, 100 * parts))).first()[0]
    bounds = sorted({0, *(c + 1 for c in cuts), _END})
    return list(zip(bounds, bounds[1:]))


def _counts(counts: list[DataFrame], langs: list[str], start: int, end: int) -> list[dict[str, tuple[np.ndarray, np.ndarray]]]:
    """Per order and language the sorted keys and counts that the n-grams of a range of cells need."""
    out = []
    for n, table in enumerate(counts, 1):
        if n == 2:  # the n-gram's first character is the nearer one of the cell
            table = table.where(F.shiftright("key", 16).between(start >> 16, end - 1 >> 16))
        elif n > 2:
            table = table.where((_cell() >= start) & (_cell() < end))
        table = table.select("lang", "key", "n").toArrow()
        lang = pc.index_in(table.column("lang"), pa.array(langs, pa.string())).to_numpy()
        keys, n = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy().astype(float)
        order = np.lexsort((keys, lang))
        cuts = np.searchsorted(lang[order], np.arange(len(langs) + 1))
        out.append({name: (keys[order[a:b]], n[order[a:b]]) for name, a, b in zip(langs, cuts, cuts[1:]) if b > a})
    return out


def train_languages(docs: DataFrame, train: Column | None = None, text_col: str = "text", lang_col: str = "lang") -> dict:
    """The model from all rows with a text and a language (and ``train``, if given).

    ``parts`` has a range of cells and the broadcast counts of each part, one at
    a time on the driver; ``counts`` are those of a model of one part. Texts without a letter teach nothing. With no such row there is no language,
    and every text is ``und``.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.lit(True) if train is None else train))
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = [materialise(count_grams(rows), "lang-grams")]
    for n in range(ORDER - 1, 0, -1):  # continuation counts: distinct n-grams by the one they end in
        shorter = F.col("key").bitwiseAND(F.lit((1 << 16 * n) - 1))
        counts.append(materialise(counts[-1].groupBy("lang", shorter.alias("key")).agg(F.count("*").alias("n")), "lang-grams"))
    counts.reverse()
    langs = sorted(r[0] for r in counts[0].select("lang").distinct().collect())
    model = {"key": uuid.uuid4().hex, "langs": langs, "parts": [], "counts": None, "limits": None}
    if langs:
        ranges = _ranges(counts)
        for start, end in ranges:
            own = _counts(counts, langs, start, end)
            model["parts"].append((start, end, docs.sparkSession.sparkContext.broadcast(own)))
            model["counts"] = own if len(ranges) == 1 else None
        model["limits"] = _limits(rows, model)
    return model


def _limits(rows: DataFrame, model: dict) -> list[float]:
    """Per language, the entropy that all but a few of its training texts stay below: the quantile over all that are told right.

    Every training text is scored. Counts by narrow bins of entropy tell the bins of
    the two texts that the quantile lies between; only these bins' distinct entropies
    come to the driver.
    """
    scored = identify(rows.withColumn("doc_id", F.lit(0)), model, extra="lang")
    scored = scored.where(F.col("lang") == F.col("lang_pred")).select("lang", "entropy", F.floor(F.col("entropy") * BINS).alias("bin"))
    scored = materialise(scored, "lang-entropies")
    sizes: dict[str, list[tuple[int, int]]] = {}
    for r in scored.groupBy("lang", "bin").count().collect():
        sizes.setdefault(r["lang"], []).append((r["bin"], r["count"]))
    places, wanted = {}, []
    for lang, some in sizes.items():
        bins, n = np.array(sorted(some)).T
        end = np.cumsum(n)
        at = REJECT * (end[-1] - 1)
        first, last = np.searchsorted(end, [math.floor(at), math.ceil(at)], "right")
        places[lang] = (at, int(end[first] - n[first]))
        wanted += [(lang, int(bins[i])) for i in {first, last}]
    if not wanted:
        return [float("inf")] * len(model["langs"])
    near = scored.join(F.broadcast(scored.sparkSession.createDataFrame(wanted, "lang string, bin bigint")), ["lang", "bin"], "left_semi")
    found: dict[str, list[tuple[float, int]]] = {}
    for r in near.groupBy("lang", "entropy").count().collect():
        found.setdefault(r["lang"], []).append((r["entropy"], r["count"]))
    limits = {}
    for lang, (at, before) in places.items():
        entropy, n = zip(*sorted(found[lang]))
        pair = np.searchsorted(before + np.cumsum(n), [math.floor(at), math.ceil(at)], "right")
        limits[lang] = float(np.quantile([entropy[i] for i in pair], at - math.floor(at)))
    return [limits.get(lang, float("inf")) for lang in model["langs"]]


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", extra: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, lang_pred, score, entropy, rejected``.

    ``lang_pred`` is a learned language, or ``und`` (score 0) for a null text or
    one without a letter. ``score`` is the language's share of the likelihood of
    at most ``SURE`` average characters; ties go to the first language by name.
    ``rejected`` marks texts unlike any learned language. Ids may be null or
    repeat; an empty table gives no rows; further columns are ignored.
    """
    key, limits, langs, parts = model["key"], model["limits"], model["langs"], model["parts"]
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       *([F.col(extra).cast("string").alias(extra)] if extra else []))
    kept = f"{extra} string, " if extra else ""
    schema = f"doc_id bigint, {kept}lang_pred string, score double, entropy double, rejected boolean"

    def losses(part):
        """Per text of a column, what ``Tables.losses`` gives for a part; None for a text without a letter."""
        start, end, shared = part

        def run(texts):
            tables = worker_state(("languages", key, start), lambda: Tables(shared.value, langs))
            return [tables.losses(t, start, end) if has_letter(t := text.as_py()) else None for text in texts]
        return run

    def verdicts(batch, sums):
        """The result for a batch of ``doc_id`` and further columns, from what the texts' sums are."""
        out = []
        for found in sums:
            if found is None:
                out.append((UNKNOWN, 0.0, None, True))
                continue
            total, size = found
            entropy = total / max(1, size)
            best = int(np.argmin(entropy))
            share = 1.0 / np.exp(-(entropy - entropy[best]) * min(size, SURE)).sum()
            out.append((langs[best], float(share), float(entropy[best]), bool(limits) and bool(entropy[best] > limits[best])))
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()),
             pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.bool_())],
            [*batch.schema.names, "lang_pred", "score", "entropy", "rejected"])

    if len(parts) <= 1:
        score = losses(parts[0]) if parts else lambda texts: [None] * len(texts)

        def run(batches):
            for batch in batches:
                yield verdicts(batch.drop_columns(["text"]), score(batch.column(1)))

        return rows.mapInArrow(run, schema)

    # Several parts: the texts are written once with a number, and read by every part; only sums are shuffled.
    rows = materialise(rows.withColumn("__llm_row", F.monotonically_increasing_id()), "lang-rows")

    def scored(part):
        score = losses(part)

        def run(batches):
            for batch in batches:
                found = [(row, *x) for row, x in zip(batch.column(0).to_pylist(), score(batch.column(1))) if x is not None]
                columns = list(zip(*found)) or [()] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array([x.tolist() for x in columns[1]], pa.list_(pa.float64())),
                     pa.array(columns[2], pa.int64())], ["__llm_row", "total", "size"])

        return rows.select("__llm_row", "text").mapInArrow(run, "__llm_row bigint, total array<double>, size bigint")

    def finish(batches):
        for batch in batches:
            sums = [None if n is None else (np.array(x), n) for x, n in zip(batch.column("total").to_pylist(), batch.column("size").to_pylist())]
            yield verdicts(batch.drop_columns(["total", "size"]), sums)

    totals = F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(len(langs))])
    sums = (reduce(DataFrame.unionAll, map(scored, parts)).groupBy("__llm_row")
            .agg(totals.alias("total"), F.sum("size").alias("size")))
    return rows.drop("text").join(sums, "__llm_row", "left").drop("__llm_row").mapInArrow(finish, schema)
