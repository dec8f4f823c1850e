"""Language of documents and of their lines, by interpolated Kneser-Ney character models.

One model of letters within words is fitted for each language on a bounded sample of labelled documents. All
models lie in one set of sorted hash arrays, one for each order, with a column for each language. A line takes the
language with the lowest cross-entropy for each letter; it is rejected if that is above what running text of the
language has, as measured on the sample. Words are scored once for each Python worker, however often they occur.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANGUAGES = ("en", "de", "fr", "es", "pt", "nl")
#: How labels spell each language (lower case, up to the first hyphen or underscore).
SPELLINGS = {
    "en": "en eng english", "de": "de deu ger german deutsch", "fr": "fr fra fre french français francais",
    "es": "es spa spanish español espanol castilian", "pt": "pt por portuguese português portugues", "nl": "nl nld dut dutch nederlands flemish",
}
#: Labelled documents for each language, and characters of each, that the models are fitted on: the bound of the sample.
SAMPLE_DOCUMENTS, SAMPLE_CHARS = 150, 6_000
ORDER = 5
#: Letters of running text that a line in another language must have.
LINE_LETTERS = 40
#: Robust standard deviations above the median cross-entropy of the sample's lines from which a line is rejected.
REJECT_AT = 6.0
#: Words that a Python worker remembers before it starts afresh.
REMEMBERED = 400_000

_TOKENS = re.compile(r"\w+").findall
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def label_language(label: Column) -> Column:
    """The language that a label names in whatever spelling, null if it names none of the six."""
    first = F.regexp_extract(F.lower(F.regexp_replace(label, r"^\s+|\s+$", "")), r"^([^\-_ ]+)", 1)
    return F.element_at(F.create_map(*[F.lit(x) for lang, names in SPELLINGS.items() for name in names.split() for x in (name, lang)]), first)


def _laid_out(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of ``_word_`` of every word in one row; the place and the word of every letter after the first."""
    text = "".join(f"_{w}_" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    inside = np.arange(len(codes)) - np.repeat(starts, lengths)
    return codes, inside, starts


def _hashes(codes: np.ndarray, inside: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each order n: places whose n letters lie in one word, and the hash of those letters."""
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, order + 1):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[n - 1 :] = codes[: len(codes) - n + 1]
        h = h ^ ((shifted + np.uint64(n)) * _MULTIPLY)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        at = np.flatnonzero(inside >= max(n - 1, 1))
        yield n, at, h[at] ^ (h[at] >> np.uint64(32))


class Models:
    """Kneser-Ney models of several languages in sorted hash arrays.

    For each order, ``keys`` are the sorted hashes of all sequences of that many letters, ``gain`` what each adds
    to a letter's probability and ``keep`` the weight that a context leaves to the next lower order.
    """

    def __init__(self, counts: list[dict[str, int]], order: int = ORDER) -> None:
        self.order, k = order, len(counts)
        self.keys: list[np.ndarray] = []
        self.gain: list[np.ndarray] = []
        self.context_keys: list[np.ndarray] = []
        self.keep: list[np.ndarray] = []
        tables = [self._sequences(c) for c in counts]
        for n in range(1, order + 1):
            keys = np.unique(np.concatenate([t[n][0] for t in tables]))
            contexts = np.unique(np.concatenate([t[n][1] for t in tables]))
            gain, keep = np.zeros((len(keys), k), np.float32), np.ones((len(contexts), k), np.float32)
            for lang, t in enumerate(tables):
                h, c, times = t[n]
                if not len(h):
                    continue
                once, twice = (times == 1).sum(), (times == 2).sum()
                discount = float(once / (once + 2 * twice)) if once + twice else 0.5
                own, at = np.unique(c, return_inverse=True)
                total = np.bincount(at, weights=times)
                kinds = np.bincount(at)
                gain[np.searchsorted(keys, h), lang] = np.maximum(times - discount, 0) / total[at]
                keep[np.searchsorted(contexts, own), lang] = discount * kinds / total
            self.keys.append(keys)
            self.gain.append(gain)
            self.context_keys.append(contexts)
            self.keep.append(keep)
        self.letters = 400.0  # the letters among which the lowest order shares its rest evenly

    def _sequences(self, counts: dict[str, int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each order: hashes of the sequences, of their contexts, and counts (of left neighbours below the top)."""
        words = list(counts)
        codes, inside, starts = _laid_out(words)
        weight = np.repeat(np.fromiter(counts.values(), np.int64, len(words)), np.fromiter((len(w) + 2 for w in words), np.int64, len(words))) if words else np.zeros(0, np.int64)
        hashed = {n: (at, h) for n, at, h in _hashes(codes, inside, self.order)}
        full = {n: self._spread(at, h, len(codes)) for n, (at, h) in hashed.items()}
        out = {}
        for n, (at, h) in hashed.items():
            context = full[n - 1][at - 1] if n > 1 else np.zeros(len(at), np.uint64)
            if n > 1:
                first = inside[at - 1] < max(n - 2, 1)
                context = np.where(first, np.uint64(1), context)
            if n == self.order:
                keys, index = np.unique(h, return_index=True)
                times = np.bincount(np.searchsorted(keys, h), weights=weight[at]).astype(np.int64)
            else:
                longer_at, longer = hashed[n + 1]
                pairs, index_longer = np.unique(longer, return_index=True)
                ends = longer_at[index_longer]
                seen = full[n][ends]
                begin = (inside[at] == max(n - 1, 1)) & (inside[at] < n)  # nothing lies before the word: counted as it stands
                own = np.concatenate([seen, np.repeat(h[begin], 1)])
                keys, inverse = np.unique(own, return_inverse=True)
                times = np.bincount(inverse)
                place = {int(x): i for i, x in zip(range(len(h) - 1, -1, -1), h[::-1], strict=True)}
                index = np.fromiter((place[int(x)] for x in keys), np.int64, len(keys))
            out[n] = (keys, context[index], times)
        return out

    @staticmethod
    def _spread(at: np.ndarray, h: np.ndarray, size: int) -> np.ndarray:
        full = np.zeros(size, np.uint64)
        full[at] = h
        return full

    def score(self, words: list[str]) -> np.ndarray:
        """Log-probability of every word (its letters and its end) in every language."""
        codes, inside, starts = _laid_out(words)
        k = self.gain[0].shape[1]
        p = np.full((len(codes), k), 1 / self.letters, np.float32)
        before = None
        for n, at, h in _hashes(codes, inside, self.order):
            context = np.zeros(len(at), np.uint64) if n == 1 else np.where(inside[at - 1] < max(n - 2, 1), np.uint64(1), before[at - 1])
            known, keep = self._found(self.context_keys[n - 1], context, self.keep[n - 1], 1.0)
            _, gain = self._found(self.keys[n - 1], h, self.gain[n - 1], 0.0)
            p[at] = gain + keep * p[at]
            before = self._spread(at, h, len(codes))
        logs = np.log(np.maximum(p, 1e-9))
        logs[inside == 0] = 0
        return np.add.reduceat(logs, starts, axis=0) if len(words) else np.zeros((0, k), np.float32)

    @staticmethod
    def _found(keys: np.ndarray, wanted: np.ndarray, values: np.ndarray, otherwise: float) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[place] == wanted
        out = values[place]
        out[~hit] = otherwise
        return hit, out


def line_words(line: str) -> list[str]:
    """The words of running text of a line: runs of letters that no digit or underscore touches, in lower case."""
    return [t for t in _TOKENS(line.lower()) if t.isalpha()]


class Detector:
    """The models, what running text of each language costs, and how to read a text with them."""

    def __init__(self, models: Models, middle: np.ndarray, spread: np.ndarray) -> None:
        self.models = models
        self.limit = (middle + REJECT_AT * spread).astype(np.float64)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.zeros((1, len(LANGUAGES)), np.float32)  # the first row is for tokens that are no words
        self.sizes = np.zeros(1, np.int64)

    def __getstate__(self) -> dict:
        return {"models": self.models, "limit": self.limit}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.forget()

    def _learn(self, tokens: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.forget()
        new = [t for t in tokens if t not in self.known]
        words = [t for t in new if t.isalpha()]
        at = len(self.scores)
        for t in new:
            self.known[t] = 0
        self.known.update(zip(words, range(at, at + len(words)), strict=True))
        for k in range(0, len(words), 50_000):
            block = words[k : k + 50_000]
            self.scores = np.concatenate((self.scores, self.models.score(block)))
            self.sizes = np.concatenate((self.sizes, np.fromiter(map(len, block), np.int64, len(block))))

    def lines(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each line: its language (-1: rejected), its letters, and for all languages cost a letter; letters scored."""
        tokens = [_TOKENS(x.lower()) for x in lines]
        needed = set(chain.from_iterable(tokens))
        self._learn(needed)
        if not all(map(self.known.__contains__, needed)):  # the memory was cleared for this batch
            self._learn(needed)
        counts = np.fromiter(map(len, tokens), np.int64, len(tokens))
        which = np.fromiter(map(self.known.__getitem__, chain.from_iterable(tokens)), np.int64, int(counts.sum()))
        ends = np.cumsum(counts)
        letters = np.concatenate(([0], np.cumsum(self.sizes[which])))
        letters = letters[ends] - letters[ends - counts]
        words = np.concatenate(([0], np.cumsum(which > 0)))
        words = words[ends] - words[ends - counts]
        logs = np.zeros((len(lines), len(LANGUAGES)), np.float64)
        some = counts > 0
        if some.any():
            logs[some] = np.add.reduceat(self.scores[which], (ends - counts)[some], axis=0, dtype=np.float64)
        scored = letters + words
        cost = -logs / np.maximum(scored, 1)[:, None]
        best = cost.argmin(axis=1)
        # A few letters vary more than a whole line does.
        room = 1 + 1.5 / np.sqrt(np.maximum(scored, 1))
        fits = (letters > 0) & (cost[np.arange(len(lines)), best] < self.limit[best] * room)
        return np.where(fits, best, -1), letters, cost, scored

    def read(self, texts: list[str]) -> Iterator[list[tuple[int, int, float]]]:
        """For each text: (line or -1 for the whole, language, confidence); nothing where there is no running text."""
        split = [t.split("\n") for t in texts]
        flat = [x for ls in split for x in ls]
        lang, letters, cost, scored = self.lines(flat)
        at = 0
        for ls in split:
            own = slice(at, at + len(ls))
            at += len(ls)
            good = lang[own] >= 0
            if not good.any():
                yield []
                continue
            votes = np.bincount(lang[own][good], weights=letters[own][good], minlength=len(LANGUAGES))
            main = int(votes.argmax())
            mine = good & (lang[own] == main)
            n = scored[own][mine]
            sure = confidence((cost[own][mine] * n[:, None]).sum(axis=0) / max(n.sum(), 1), main, n.sum()) * votes[main] / votes.sum()
            out = [(-1, main, float(sure))]
            for k in np.flatnonzero(good & (lang[own] != main) & (letters[own] >= LINE_LETTERS)):
                code = int(lang[own][k])
                out.append((int(k), code, confidence(cost[own][k], code, scored[own][k])))
            yield out


def confidence(cost: np.ndarray, best: int, letters: float) -> float:
    """Posterior of the best language, each language equally likely before, as if a tenth of the letters were independent."""
    weight = np.exp(-(cost - cost[best]) * max(1.0, min(float(letters), 2_000.0) / 10))
    return float(1 / weight.sum())


def agreeing_lines(lines: list[tuple[int, list[str]]], rounds: int = 4) -> list[tuple[int, list[str]]]:
    """The lines whose words are likeliest in the language of their label.

    Word frequencies of all lines of a label come first; every round counts only the lines that agreed before. A
    label that is wrong for a part of its documents makes their words rarer in it by that part, so they disagree.
    """
    words = {w: i for i, w in enumerate(sorted(set(chain.from_iterable(ws for _, ws in lines))))}
    kinds = np.fromiter((k for k, _ in lines), np.int64, len(lines))
    sizes = np.fromiter((len(ws) for _, ws in lines), np.int64, len(lines))
    flat = np.fromiter((words[w] for _, ws in lines for w in ws), np.int64, int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    good = np.ones(len(lines), bool)
    for _ in range(rounds):
        counts = np.full((len(words), len(LANGUAGES)), 0.05)
        seen = np.repeat(good, sizes)
        np.add.at(counts, (flat[seen], np.repeat(kinds, sizes)[seen]), 1)
        logs = np.log(counts / counts.sum(axis=0))
        good = np.add.reduceat(logs[flat], starts, axis=0).argmax(axis=1) == kinds
    return [x for x, ok in zip(lines, good, strict=True) if ok]


def fit(labelled: list[tuple[str, str]]) -> Detector:
    """A detector from (language, text) rows; labels may be wrong here and there.

    The models count only the lines that agree with their label, so that wrong labels and embedded lines of other
    languages do not teach the wrong model. Half of the agreeing lines fit a model that the other half measures:
    what running text costs at most, and how that varies, comes from lines that the model has not seen.
    """
    lines = [(LANGUAGES.index(lang), line_words(line)) for lang, text in labelled for line in text.split("\n")]
    lines = [(k, ws) for k, ws in lines if sum(map(len, ws)) >= 20]
    lines = agreeing_lines(lines) if lines else lines
    half = _models(lines[::2])
    words = sorted(set(chain.from_iterable(ws for _, ws in lines[1::2])))
    place, scores = {w: i for i, w in enumerate(words)}, half.score(words)
    cost = defaultdict(list)
    for k, ws in lines[1::2]:
        cost[k].append(-scores[[place[w] for w in ws], k].sum() / (sum(map(len, ws)) + len(ws)))
    middle = np.array([np.median(cost[k]) if cost[k] else 2.5 for k in range(len(LANGUAGES))])
    spread = np.array([max(1.4826 * np.median(np.abs(np.array(cost[k]) - middle[k])), 0.05) if cost[k] else 0.3 for k in range(len(LANGUAGES))])
    return Detector(_models(lines), middle, spread)


def _models(lines: list[tuple[int, list[str]]]) -> Models:
    counts: list[Counter] = [Counter() for _ in LANGUAGES]
    for k, ws in lines:
        counts[k].update(ws)
    return Models([dict(c) or {"": 1} for c in counts])


def sample(documents: DataFrame, per_language: int = SAMPLE_DOCUMENTS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """At most ``per_language`` labelled texts of each language, at most ``chars`` characters of each.

    The documents with the least seeded hash are taken; only ids and labels are ranked, and at most
    ``6 * per_language`` ids are joined back to the texts. Only the fitting uses this sample.
    """
    ids = documents.select("doc_id", label_language(F.col("lang")).alias("_l")).where(F.col("_l").isNotNull())
    ranked = ids.withColumn("_n", F.row_number().over(Window.partitionBy("_l").orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id"))).where(F.col("_n") <= per_language)
    rows = documents.select("doc_id", "text").join(F.broadcast(ranked.select("doc_id", "_l")), "doc_id").where(F.length("text") > 0)
    return sorted((r["_l"], r["t"]) for r in rows.select("_l", F.left("text", F.lit(chars)).alias("t")).collect())


def detect_languages(documents: DataFrame, detector: Detector | None = None) -> DataFrame:
    """(doc_id, line_no, lang, confidence, label_lang): the main language of each document (line_no -1), and each
    line of at least 40 letters in another one of the six.

    Null, empty and blank texts and texts without running text in one of the six languages have no row. ``label_lang``
    is the language that the document's label names, null if none. Whole texts are read; nothing is shuffled.
    """
    tool = documents.sparkSession.sparkContext.broadcast(detector or fit(sample(documents)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                docs, texts, labels = (batch.column(k).to_pylist() for k in range(3))
                rows = [(d, *x, l) for d, l, found in zip(docs, labels, tool.value.read([t or "" for t in texts]), strict=True) for x in found]
                ids, lines, langs, sure, named = (list(c) for c in zip(*rows, strict=True)) if rows else ([], [], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(lines, pa.int64()), pa.array([LANGUAGES[k] for k in langs], pa.string()), pa.array(sure, pa.float64()), pa.array(named, pa.string())],
                    names=["doc_id", "line_no", "lang", "confidence", "label_lang"],
                )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", label_language(F.col("lang")).alias("label"))
    return rows.mapInArrow(run, "doc_id bigint, line_no bigint, lang string, confidence double, label_lang string")


def found_languages(detected: DataFrame) -> DataFrame:
    """(doc_id, line_no, lang): documents whose label does not name their main language, and lines in another one."""
    return detected.where((F.col("line_no") >= 0) | ~F.col("lang").eqNullSafe(F.col("label_lang"))).select("doc_id", "line_no", "lang")
