"""Byte-pair encoding with a public vocabulary, by a pair occurrence index.

The distinct pre-tokens that a partition meets are laid out in one row of symbols. Every adjacent pair that has a
rank is indexed with all its positions. Ranks are then taken in ascending order: all positions of the rank are
merged at once, and the pairs that this makes or breaks update the position lists of their ranks. Pre-tokens that
were encoded before are looked up, so a word is encoded once for each Python worker however often it occurs.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from paperloom.llm.arrow import offsets, ragged

#: Where the public vocabularies lie; a parameter of every operator, this is its default.
TOKENIZERS = os.environ.get("PAPERLOOM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: the pattern that parts a text before merges, with white space by its Unicode property.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Pre-tokens that a Python worker remembers before it starts afresh.
REMEMBERED = 600_000


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class PairIndex:
    """Merges of a vocabulary, and the encoding of many words at once."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.first = [vocab[a] for a, _ in pairs]
        self.second = [vocab[b] for _, b in pairs]
        self.merged = [vocab[a + b] for a, b in pairs]
        letters = byte_letters()
        self.byte_ids = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.rank = {a << 32 | b: r for r, (a, b) in enumerate(zip(self.first, self.second, strict=True))}
        keys = np.fromiter(self.rank.keys(), np.int64, len(self.rank))
        ranks = np.fromiter(self.rank.values(), np.int64, len(self.rank))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], ranks[order]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has. No word may be empty."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        row = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(lengths) - 1
        word_of = np.repeat(np.arange(len(words)), lengths)
        follow = np.arange(1, len(row) + 1)
        follow[ends] = -1
        before = np.arange(-1, len(row) - 1)
        before[ends - lengths + 1] = -1

        at = np.flatnonzero(follow >= 0)
        key = row[at] << 32 | row[at + 1] if len(at) else np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[place] == key
        at, found = at[hit], self.ranks[place[hit]]
        order = np.argsort(found, kind="stable")
        at, found = at[order], found[order]
        cuts = np.flatnonzero(np.diff(found, prepend=-1))
        active = {int(found[c]): part.tolist() for c, part in zip(cuts, np.split(at, cuts[1:]), strict=True)} if len(at) else {}
        heap = sorted(active)

        symbol, nxt, prv = row.tolist(), follow.tolist(), before.tolist()
        rank, merged, first, second = self.rank, self.merged, self.first, self.second
        while heap:
            r = heapq.heappop(heap)
            places = active.pop(r, None)
            if places is None:
                continue
            a, b, new = first[r], second[r], merged[r]
            places.sort()
            for p in places:
                q = nxt[p]
                if q < 0 or symbol[p] != a or symbol[q] != b:
                    continue  # a merge before took one of the two
                symbol[p], symbol[q] = new, -1
                q = nxt[p] = nxt[q]
                if q >= 0:
                    prv[q] = p
                    other = rank.get(new << 32 | symbol[q])
                    if other is not None:
                        if other in active:
                            active[other].append(p)
                        else:
                            active[other] = [p]
                            heapq.heappush(heap, other)
                q = prv[p]
                if q >= 0:
                    other = rank.get(symbol[q] << 32 | new)
                    if other is not None:
                        if other in active:
                            active[other].append(q)
                        else:
                            active[other] = [q]
                            heapq.heappush(heap, other)
        done = np.array(symbol, np.int64)
        alive = done >= 0
        return done[alive], np.bincount(word_of[alive], minlength=len(words))


class Encoder:
    """Encodes texts and remembers pre-tokens."""

    def __init__(self, path: str) -> None:
        self.pairs = PairIndex(path)
        self.part = regex.compile(PATTERN).findall
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def pieces(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pre-tokens of all texts, and how many each text has."""
        parted = [self.part(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self._forget()
        known = self.known
        new = [w for w in set(chain.from_iterable(parted)) if w not in known]
        if new:
            ids, counts = self.pairs.encode([w.encode("utf-8", "surrogatepass") for w in new])
            self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(counts) - counts))
            self.lengths = np.concatenate((self.lengths, counts))
            self.flat = np.concatenate((self.flat, ids))
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        counts = np.fromiter(map(len, parted), np.int64, len(parted))
        return np.fromiter(map(known.__getitem__, chain.from_iterable(parted)), np.int64, int(counts.sum())), counts

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has; null and empty texts have none."""
        which, counts = self.pieces(texts)
        return ragged(self.flat, self.starts[which], self.lengths[which]), self._sums(which, counts)

    def count(self, texts: list[str | None]) -> np.ndarray:
        """How many ids each text has."""
        return self._sums(*self.pieces(texts))

    def _sums(self, which: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(self.lengths[which])))
        ends = np.cumsum(counts)
        return total[ends] - total[ends - counts]


@lru_cache(maxsize=4)
def encoder(folder: str, vocabulary: str) -> Encoder:
    """The encoder of this Python worker."""
    return Encoder(os.path.join(folder, vocabulary))


#: Texts that are encoded at once.
_BLOCK = 2_000


def _encoded(folder: str, vocabulary: str, count_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(*_place(folder, vocabulary))
        for whole in batches:
            for at in range(0, whole.num_rows, _BLOCK):
                batch = whole.slice(at, _BLOCK)
                texts = batch.column(batch.num_columns - 1).to_pylist()
                if count_only:
                    out: pa.Array = pa.array(tool.count(texts), pa.int64())
                else:
                    ids, counts = tool.encode(texts)
                    out = pa.ListArray.from_arrays(pa.array(offsets(counts), pa.int32()), pa.array(ids, pa.int64()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], out], names=[*batch.schema.names[:-1], "out"])

    return run


def _place(folder: str, vocabulary: str) -> tuple[str, str]:
    """Where an executor finds the vocabulary: beside the files that the driver sent, else in the folder named."""
    sent = SparkFiles.get(vocabulary)
    return (os.path.dirname(sent), vocabulary) if os.path.isfile(sent) else (folder, vocabulary)


_sent: set[tuple[str, str]] = set()


def send_vocabulary(spark: SparkSession, folder: str, vocabulary: str) -> None:
    """Send the vocabulary to every executor, once for each application, where the driver has it: executors need no copy at
    the same path. Two vocabularies of one name in different folders are refused by Spark."""
    path, key = os.path.join(folder, vocabulary), (spark.sparkContext.applicationId, vocabulary)
    if key not in _sent and os.path.isfile(path):
        _sent.add(key)
        spark.sparkContext.addFile(path)


def _mapped(df: DataFrame, keep: list[str], text: str, out: str, kind: str, folder: str, vocabulary: str) -> DataFrame:
    send_vocabulary(df.sparkSession, folder, vocabulary)
    rows = df.select(*keep, df[text].alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_encoded(folder, vocabulary, kind == "bigint"), f"{schema}{', ' if keep else ''}out {kind}").withColumnRenamed("out", out)


def encode_texts(df: DataFrame, keep: list[str], text: str, out: str = "ids", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows (keep..., out): the ids of each text as a list of integers, without special tokens.

    Null and empty texts have an empty list. Strings that name special tokens are ordinary text. Every task works
    on its own rows; nothing is shuffled. Repeated rows keep their repeats.
    """
    return _mapped(df, keep, text, out, "array<bigint>", folder, vocabulary)


def count_tokens(df: DataFrame, keep: list[str], text: str, out: str = "n_tokens", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows (keep..., out): how many ids each text has; 0 for null and empty texts."""
    return _mapped(df, keep, text, out, "bigint", folder, vocabulary)
