"""Comparison of document sets: pairing of files, differences of texts, signals of age."""

from __future__ import annotations

import difflib
import heapq
import re
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations, groupby
from math import comb
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import pairing_key
from paperloom.session import materialize

FUZZY, CHANGED = 0.9, 0.6
#: Texts that occur more often than this in a place are looked at only where no block with a rarer one can be the longest.
RARE = 16
#: Likeness above which names are paired first, so that fewer are left for the weaker filters of lower ones.
LEVELS = (0.96, 0.93)
#: Pairs of names of two lengths up to which all are compared, and pairs that are compared in the time that a form takes.
MANY, FORM_COST = 1 << 34, 128
#: Pairs and names of each side that one task compares, about; pairs that are compared at once, and pairs held for the next step.
TASK_PAIRS, TASK_NAMES, AT_ONCE, HELD = 100_000_000, 1 << 15, 1 << 15, 1 << 20
#: Classes of characters: bits for the counts of each (digits, others; others in finer classes), and symbols that are told apart.
DIGIT_BITS, OTHER_BITS, FINE_BITS, SYMBOLS = [5] * 10, [2] * 7, [2] * 32, 91
#: Most shortened forms of a name that are compared whole; most characters without partner of two names that are compared by
#: halves, and the shortest half.
FORMS, APART, HALF = 500, 5, 8
#: Bytes of forms that are matched at once, and names that are shortened at once.
PART_BYTES, NAMES = 8 << 20, 1_000


def least_shared(n1: int, n2: int, threshold: float) -> int:
    """The fewest matched characters with which texts of these lengths are more alike than the threshold."""
    least = max(0, int(threshold * (n1 + n2) / 2) - 1)
    while 2.0 * least / (n1 + n2) <= threshold:
        least += 1
    return least


def sides(n1: int, n2: int, threshold: float) -> tuple[str, list[list[tuple]]] | None:
    """How names of these lengths are compared, and what each side does for it: (salt, from the end, characters taken, characters
    left out) for every kind of shortened form. None if they can't be more alike than the threshold.

    Names with a common subsequence of M characters have an equal form once all but M are left out (``whole``). Where these are
    too many: if at most ``APART`` characters have no partner, either the first half of the first name and what stands before a
    cut of the second have less than half of them, or the rest of both at most half (``halves``). Else there are no forms that
    are few enough (``all``), and every pair is compared.
    """
    least = least_shared(n1, n2, threshold)
    if least > min(n1, n2):
        return None
    a, b = n1 - least, n2 - least
    if comb(n1, a) <= FORMS and comb(n2, b) <= FORMS:
        return "whole", [[(f"{least}", False, n1, a)], [(f"{least}", False, n2, b)]]
    half = n1 // 2
    if a + b > APART or half < HALF:
        return "all", [[], []]
    out: list[list[tuple]] = [[], []]
    for back, taken, most in ((False, half, (a + b - 1) // 2), (True, n1 - half, (a + b) // 2)):
        for x in range(min(a, most) + 1):
            for y in range(min(b, most - x) + 1):
                if taken - x + y <= n2:
                    salt = f"{back} {taken} {x} {y}"
                    out[0].append((salt, back, taken, x))
                    out[1].append((salt, back, taken - x + y, y))
    return "halves", out


def forms(codes: np.ndarray, left_out: int) -> np.ndarray:
    """Hashes of all that remains of each row when so many of its characters are left out; equal texts have equal ones."""
    n = codes.shape[1]
    base, around = 0x9E3779B97F4A7C15, 1 << 64
    sums = np.zeros((len(codes), n + 1), np.uint64)
    np.cumsum(codes * np.array([pow(base, k, around) for k in range(n)], np.uint64), axis=1, out=sums[:, 1:])
    gone = np.array(list(combinations(range(n), left_out)), np.int64).reshape(comb(n, left_out), left_out)
    out, start = np.zeros((len(codes), len(gone)), np.uint64), np.zeros(len(gone), np.int64)
    for k in range(left_out + 1):
        end = gone[:, k] if k < left_out else np.full(len(gone), n)
        out += (sums[:, end] - sums[:, start]) * np.uint64(pow(base, -k, around))
        start = end + 1
    return out


def shortened_pairs(left: DataFrame, right: DataFrame, kinds: tuple[dict[int, list[tuple]], dict[int, list[tuple]]], parts: int) -> DataFrame:
    """(name1, k1, name2, k2): the pairs with an equal shortened form, and few others. ``kinds`` has, for each side and
    length, the forms that are compared (``sides``).

    A form is 4 bytes of its hash and 4 of its name's; those of one part of the hashes are sorted and met in one step.
    """
    from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

    kind = np.dtype([("form", "<u4"), ("id", "<i4")])

    def signed(side: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            salts: dict[str, np.uint64] = {}
            for batch in batches:
                of_length: dict[int, list[tuple[int, str]]] = {}
                for ident, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    of_length.setdefault(len(text), []).append((ident, text))
                for n, names in of_length.items():
                    for at in range(0, len(names), NAMES):
                        some = names[at : at + NAMES]
                        ids = np.array([i for i, _ in some], np.int32)
                        codes = np.array([t for _, t in some], f"U{n}").view(np.uint32).reshape(len(some), n).astype(np.uint64) + np.uint64(1) if n else np.zeros((len(some), 0), np.uint64)
                        for salt, back, taken, left_out in kinds[side].get(n, ()):
                            if salt not in salts:
                                salts[salt] = np.uint64(crc32(salt.encode()) * 0xD6E8FEB86659FD93 % (1 << 64))
                            found = forms(codes[:, n - taken :] if back else codes[:, :taken], left_out)
                            own = np.repeat(ids, found.shape[1])
                            h = found.ravel() + salts[salt]
                            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
                            h ^= h >> np.uint64(32)
                            part = ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                            order = np.argsort(part, kind="stable")
                            rows = np.empty(len(h), kind)
                            rows["form"], rows["id"] = (h & np.uint64(0xFFFFFFFF))[order], own[order]
                            which, starts = np.unique(part[order], return_index=True)
                            cut = [x.tobytes() for x in np.split(rows, starts[1:])]
                            yield pa.RecordBatch.from_arrays([pa.array(which.astype(np.int32)), pa.array([side] * len(which), pa.int32()), pa.array(cut, pa.binary())], names=["part", "side", "forms"])

        return run

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def matched(held: tuple[list, list]) -> Iterator[pa.RecordBatch]:
            a, b = (np.unique(np.frombuffer(b"".join(x), kind)) for x in held)
            low, high = np.searchsorted(b["form"], a["form"], "left"), np.searchsorted(b["form"], a["form"], "right")
            hit = np.nonzero(high > low)[0]
            ends = np.cumsum(high[hit] - low[hit])
            at = 0
            while at < len(hit):  # at most a million pairs at once, but for a form that has more
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 1_000_000, "right")))
                some, counts = hit[at:to], (high - low)[hit[at:to]]
                inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                pairs = np.unique(np.stack([np.repeat(a["id"][some], counts), b["id"][np.repeat(low[some], counts) + inside]], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["id1", "id2"])
                at = to

        now, held = None, ([], [])
        for batch in batches:
            for part, side, some in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != now:
                    yield from matched(held)
                    now, held = part, ([], [])
                held[side].append(some)
        yield from matched(held)

    schema = StructType([StructField("part", IntegerType()), StructField("side", IntegerType()), StructField("forms", BinaryType())])
    one, two = left.withColumn("id1", F.hash("name1")), right.withColumn("id2", F.hash("name2"))
    signs = one.select("id1", "k1").mapInArrow(signed(0), schema).unionByName(two.select("id2", "k2").mapInArrow(signed(1), schema))
    met = signs.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(meet, "id1 int, id2 int").distinct()
    return met.join(one, "id1").join(two, "id2").select("name1", "k1", "name2", "k2")


def counted(classes: np.ndarray, bits: list[int]) -> np.ndarray:
    """For each row, how often each class occurs, as so many ones of its bits; classes beyond ``bits`` don't count.

    The bits in which two rows differ are at most the characters without partner in both.
    """
    most = np.array(bits, np.int64)
    kinds = len(bits) + 1
    of = np.minimum(classes, len(bits)) + np.arange(len(classes))[:, None] * kinds
    counts = np.bincount(of.ravel(), minlength=len(classes) * kinds).reshape(len(classes), kinds)[:, :-1]
    ones = (np.uint64(1) << np.minimum(counts, most).astype(np.uint64)) - np.uint64(1)
    return np.bitwise_or.reduce(ones << (np.cumsum(most) - most).astype(np.uint64), axis=1)


class Names:
    """Texts of one length as arrays: their codes, and the counts of their characters, coarse and fine."""

    def __init__(self, texts: list[str]):
        self.n = len(texts[0])
        self.texts = texts
        codes = np.array(texts, f"U{self.n}").view(np.uint32).reshape(len(texts), self.n).astype(np.int64)
        digit = (codes >= 48) & (codes < 58)
        self.coarse = counted(np.where(digit, codes - 48, 10 + codes % len(OTHER_BITS)), DIGIT_BITS + OTHER_BITS)
        self.fine = counted(np.where(digit, len(FINE_BITS), codes % len(FINE_BITS)), FINE_BITS)
        self.codes = codes % SYMBOLS
        self._places: np.ndarray | None = None

    @property
    def places(self) -> np.ndarray:
        """For each text and symbol, a bit for every place where it stands (at most 64)."""
        if self._places is None:
            self._places = np.zeros((len(self.texts), SYMBOLS), np.uint64)
            for k in range(self.n):
                self._places[np.arange(len(self.texts)), self.codes[:, k]] |= np.uint64(1 << k)
        return self._places


def common(one: Names, two: Names, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The length of the longest common subsequence of every two texts (i of one, j of two), or more, where characters that
    are told apart as one symbol make it longer. Bits of a word stand for the places of the first text (Hyyro 2004)."""
    if one.n > 64:
        return np.array([common_of_long(one.texts[x], two.texts[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
    open_, table, at = np.full(len(i), (1 << 64) - 1, np.uint64), one.places.ravel(), i * SYMBOLS
    for k in range(two.n):
        met = open_ & table[at + two.codes[j, k]]
        open_ = (open_ + met) | (open_ - met)
    return one.n - np.bitwise_count(open_ & np.uint64((1 << one.n) - 1)).astype(np.int64)


def common_of_long(a: str, b: str) -> int:
    """The length of the longest common subsequence of two texts of any length."""
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    every = open_ = (1 << len(a)) - 1
    for c in b:
        met = open_ & places.get(c, 0)
        open_ = ((open_ + met) | (open_ - met)) & every
    return len(a) - open_.bit_count()


def close_pairs(one: Names, two: Names, apart: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, common) of all pairs with at most ``apart`` characters without partner, told by their longest common subsequence:
    the counts of characters are compared for every pair, all else for few."""
    digits = np.uint64((1 << sum(DIGIT_BITS)) - 1)

    def close(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        unlike = np.bitwise_count((one.coarse[i] ^ two.coarse[j]) & digits) + np.bitwise_count(one.fine[i] ^ two.fine[j])
        i, j = i[unlike <= apart], j[unlike <= apart]
        shared = common(one, two, i, j)
        near = one.n + two.n - 2 * shared <= apart
        return i[near], j[near], shared[near]

    width = min(len(two.texts), AT_ONCE // 4)
    height = max(1, AT_ONCE // width)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0
    for right in range(0, len(two.texts), width):
        some = two.coarse[right : right + width]
        for left in range(0, len(one.texts), height):
            hits = np.flatnonzero(np.bitwise_count(one.coarse[left : left + height, None] ^ some) <= apart)
            if len(hits):
                i, j = np.divmod(hits, len(some))
                held.append((left + i, right + j))
                count += len(hits)
            if count >= HELD:
                yield close(*map(np.concatenate, zip(*held, strict=True)))
                held, count = [], 0
    if held:
        yield close(*map(np.concatenate, zip(*held, strict=True)))


CANDIDATE = "name1 string, k1 string, name2 string, k2 string, bound double"


def by_length(rows: list[tuple[str, str]]) -> dict[int, tuple[pa.Array, Names]]:
    """For each length of the keys, the names with it and their keys."""
    of: dict[int, list[tuple[str, str]]] = {}
    for name, key in rows:
        of.setdefault(len(key), []).append((name, key))
    return {n: (pa.array([name for name, _ in some], pa.string()), Names([key for _, key in some])) for n, some in of.items() if n}


def candidate_rows(one: tuple[pa.Array, Names], two: tuple[pa.Array, Names], i: np.ndarray, j: np.ndarray, shared: np.ndarray) -> pa.RecordBatch:
    """Pairs as rows of ``candidates``."""
    columns = [x for (names, keys), at in ((one, i), (two, j)) for x in (names.take(pa.array(at)), pa.array([keys.texts[k] for k in at.tolist()], pa.string()))]
    return pa.RecordBatch.from_arrays([*columns, pa.array(2.0 * shared / (one[1].n + two[1].n))], names=["name1", "k1", "name2", "k2", "bound"])


def compared_pairs(left: DataFrame, right: DataFrame, apart: dict[tuple[int, int], int], pairs: int) -> DataFrame:
    """The rows of ``candidates`` of these lengths, from a comparison of all ``pairs`` pairs: both sides are cut into blocks,
    and every block of one meets every block of the other. ``apart`` has the most characters without partner."""
    side_lengths = [sorted({p[k] for p in apart}) for k in (0, 1)]
    one, two = (df.where(F.length(k).isin(ns)) for df, k, ns in ((left, "k1", side_lengths[0]), (right, "k2", side_lengths[1])))
    by_pairs = int((pairs / TASK_PAIRS) ** 0.5) + 1
    cuts = [max(by_pairs, df.count() // TASK_NAMES + 1) for df in (one, two)]

    def blocks(df: DataFrame, side: int) -> DataFrame:
        own, others = F.pmod(F.xxhash64(f"name{side + 1}"), F.lit(cuts[side])).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(cuts[1 - side] - 1)))
        cut = df.select(own.alias("own"), others.alias("other"), F.col(f"name{side + 1}").alias("name"), F.col(f"k{side + 1}").alias("k"))
        part = F.col("own") * cuts[1] + F.col("other") if side == 0 else F.col("other") * cuts[1] + F.col("own")
        return cut.select(part.alias("part"), F.lit(side).alias("side"), "name", "k")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def matched(held: tuple[list, list]) -> Iterator[pa.RecordBatch]:
            if held[0] and held[1]:
                ones, twos = map(by_length, held)
                for (x, y), most in apart.items():
                    if x in ones and y in twos:
                        for found in close_pairs(ones[x][1], twos[y][1], most):
                            yield candidate_rows(ones[x], twos[y], *found)

        now, held = None, ([], [])
        for batch in batches:
            for part, side, name, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != now:
                    yield from matched(held)
                    now, held = part, ([], [])
                held[side].append((name, key))
        yield from matched(held)

    return blocks(one, 0).unionByName(blocks(two, 1)).repartitionById(cuts[0] * cuts[1], "part").sortWithinPartitions("part").mapInArrow(meet, CANDIDATE)


def candidates(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(name1, k1, name2, k2, bound): all pairs that can be more alike than the threshold, and how alike they are at most: no
    comparison matches more characters than their longest common subsequence has. Lengths with very many names are met by
    shortened forms where these are few (``sides``), all others by a comparison of every pair. With forms, a pair may come
    twice. A null or empty key is in no pair.
    """
    lengths = [{r["n"]: r["c"] for r in df.groupBy(F.length(k).alias("n")).agg(F.count(F.lit(1)).alias("c")).collect() if r["n"]} for df, k in ((left, "k1"), (right, "k2"))]
    kinds: tuple[dict[int, list[tuple]], dict[int, list[tuple]]] = ({}, {})
    apart: dict[tuple[int, int], int] = {}
    pairs = 0
    for x, one in sorted(lengths[0].items()):
        for y, two in sorted(lengths[1].items()):
            if not (how := sides(x, y, threshold)):
                continue
            cost = FORM_COST * sum(c * comb(taken, left_out) for c, told in zip((one, two), how[1], strict=True) for _, _, taken, left_out in told)
            if how[0] == "all" or one * two <= max(MANY, cost):
                apart[x, y] = x + y - 2 * least_shared(x, y, threshold)
                pairs += one * two
                continue
            for own, n, told in zip(kinds, (x, y), how[1], strict=True):
                own[n] = list(dict.fromkeys([*own.get(n, ()), *told]))
    entries = sum(counts[n] * comb(taken, left_out) for counts, own in zip(lengths, kinds, strict=True) for n, told in own.items() for _, _, taken, left_out in told)

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of: dict[tuple[int, int], list[tuple]] = {}
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                of.setdefault((len(row[1]), len(row[3])), []).append(row)
            for (x, y), rows in of.items():
                one, two = (by_length([(r[k], r[k + 1]) for r in rows])[n] for k, n in ((0, x), (2, y)))
                every = np.arange(len(rows))
                shared = common(one[1], two[1], every, every)
                near = 2.0 * shared / (x + y) > threshold
                yield candidate_rows(one, two, every[near], every[near], shared[near])

    found = [shortened_pairs(left, right, kinds, 1 + 8 * entries // PART_BYTES).mapInArrow(bound, CANDIDATE)] if entries else []
    if apart:
        found.append(compared_pairs(left, right, apart, pairs))
    return reduce(DataFrame.unionByName, found) if found else left.sparkSession.createDataFrame([], CANDIDATE)


def alike_pairs(left: DataFrame, right: DataFrame, threshold: float = FUZZY) -> DataFrame:
    """(name1, name2, how): of all names of both sides (name1, k1) and (name2, k2) those whose keys are more alike than
    the threshold, greedily from the most alike. The choice itself is one task over the pairs, sorted by how alike they are at most;
    how alike they are is told for those only whose names are both free when it is their turn."""
    spark = left.sparkSession

    def pick(above: float):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            used1, used2 = set(), set()
            told: list[tuple[float, str, str]] = []  # pairs that are less alike than they can be, or whose turn comes next

            def choose(before: tuple[float, str, str] | None) -> Iterator[tuple[str, str, str]]:
                while told and (before is None or told[0] < before):
                    _, x, y = heapq.heappop(told)
                    if x not in used1 and y not in used2:
                        used1.add(x)
                        used2.add(y)
                        yield x, y, "fuzzy"

            def rows(out: list[tuple[str, str, str]]) -> pa.RecordBatch:
                columns = list(zip(*out, strict=True)) or [()] * 3
                return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["name1", "name2", "how"])

            for batch in batches:
                out = []
                for x, k1, y, k2, bound in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    out += choose((-bound, x, y))
                    if x not in used1 and y not in used2 and (score := difflib.SequenceMatcher(None, k1, k2).ratio()) > above:
                        heapq.heappush(told, (-score, x, y))
                yield rows(out)
            yield rows(list(choose(None)))

        return run

    found = spark.createDataFrame([], "name1 string, name2 string, how string")
    left, right = materialize(left), materialize(right)
    levels = [*(x for x in LEVELS if x > threshold), threshold]
    for above in levels:
        chosen = materialize(candidates(left, right, above).repartition(1).sortWithinPartitions(F.desc("bound"), "name1", "name2").mapInArrow(pick(above), "name1 string, name2 string, how string"))
        found = found.unionByName(chosen)
        if above != levels[-1]:
            left, right = (materialize(df.join(chosen, n, "left_anti")) for df, n in ((left, "name1"), (right, "name2")))
    return found


def pair_files(first: DataFrame, second: DataFrame, name: str = "filename", threshold: float = FUZZY) -> DataFrame:
    """(name1, name2, how): pairs by equal names, then by normalised names, then by likeness; the rest are orphans.

    What each step finds is written into the shared folder, as the next ones work on the rest. Within a normalised name, files pair in order. Likeness is compared among all names that are left, greedily from
    the most alike (``alike_pairs``).
    """
    a = first.select(F.col(name).alias("name1")).distinct()
    b = second.select(F.col(name).alias("name2")).distinct()
    exact = a.join(b, F.lower("name1") == F.lower("name2")).groupBy("name1").agg(F.min("name2").alias("name2")).withColumn("how", F.lit("exact"))
    exact = materialize(exact)
    numbered = lambda df, c: df.withColumn("_k", pairing_key(F.col(c))).withColumn("_n", F.row_number().over(Window.partitionBy("_k").orderBy(c)))
    a1, b1 = (materialize(numbered(x.join(exact, n, "left_anti"), n)) for x, n in ((a, "name1"), (b, "name2")))
    likely = materialize(a1.join(b1, ["_k", "_n"]).select("name1", "name2", F.lit("normalised").alias("how")))
    a2, b2 = a1.join(likely, "name1", "left_anti"), b1.join(likely, "name2", "left_anti")
    fuzzy = alike_pairs(a2.select("name1", F.col("_k").alias("k1")), b2.select("name2", F.col("_k").alias("k2")), threshold)
    pairs = exact.select("name1", "name2", "how").unionByName(likely).unionByName(fuzzy)
    only1 = a.join(pairs, "name1", "left_anti").select("name1", F.lit(None).cast("string").alias("name2"), F.lit("orphan").alias("how"))
    only2 = b.join(pairs, "name2", "left_anti").select(F.lit(None).cast("string").alias("name1"), "name2", F.lit("orphan").alias("how"))
    return pairs.unionByName(only1).unionByName(only2)


def word_ops(a: str, b: str) -> list[dict[str, str]]:
    """Equal, deleted and inserted stretches between two texts, word by word."""
    left, right = re.findall(r"\s+|\S+", a or ""), re.findall(r"\s+|\S+", b or "")
    out = []
    for op, i1, i2, j1, j2 in difflib.SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        if op == "equal":
            out.append({"op": "equal", "text": "".join(left[i1:i2])})
        else:
            if i2 > i1:
                out.append({"op": "delete", "text": "".join(left[i1:i2])})
            if j2 > j1:
                out.append({"op": "insert", "text": "".join(right[j1:j2])})
    return out


class BlockMatcher(difflib.SequenceMatcher):
    """The blocks of ``SequenceMatcher`` without junk, found from the rare elements.

    A block without a rare element is at most as long as the longest stretch of frequent ones. Where a longer block
    exists, all longest blocks are reached by extending matches of rare elements, and the pairs of frequent elements,
    whose number is quadratic, are not visited; elsewhere the original search decides.
    """

    def __init__(self, a: list, b: list):
        super().__init__(None, a, b, autojunk=False)
        self.rare = {t: js for t, js in self.b2j.items() if len(js) <= RARE}
        self.stretch = max((sum(1 for _ in g) for rare, g in groupby(b, self.rare.__contains__) if not rare), default=0)

    def find_longest_match(self, alo: int = 0, ahi: int | None = None, blo: int = 0, bhi: int | None = None) -> difflib.Match:
        a, b = self.a, self.b
        ahi, bhi = len(a) if ahi is None else ahi, len(b) if bhi is None else bhi
        best, done = (0, alo, blo), {}  # done: the end in a of the last run of each diagonal
        for i in range(alo, ahi):
            for j in self.rare.get(a[i], ()):
                if j < blo or done.get(i - j, -1) > i:
                    continue
                if j >= bhi:
                    break
                back, on = 0, 1
                while i - back > alo and j - back > blo and a[i - back - 1] == b[j - back - 1]:
                    back += 1
                while i + on < ahi and j + on < bhi and a[i + on] == b[j + on]:
                    on += 1
                done[i - j] = i + on
                best = min(best, (-back - on, i - back, j - back))
        if -best[0] > self.stretch:
            return difflib.Match(best[1], best[2], -best[0])
        return super().find_longest_match(alo, ahi, blo, bhi)


def unequal(first: list[tuple[int, str]], second: list[tuple[int, str]]) -> Iterator[tuple]:
    """(index1, text1, index2, text2) where two ordered lists of paragraphs differ; what has no partner has nulls."""
    for op, i1, i2, j1, j2 in BlockMatcher([t for _, t in first], [t for _, t in second]).get_opcodes():
        if op != "equal":
            for k in range(max(i2 - i1, j2 - j1)):
                yield *(first[i1 + k] if i1 + k < i2 else (None, None)), *(second[j1 + k] if j1 + k < j2 else (None, None))


def difference(index1: int | None, text1: str | None, index2: int | None, text2: str | None) -> tuple:
    """(index1, index2, kind, text1, text2, ops) of one of ``unequal``'s rows."""
    if index1 is None or index2 is None:
        op, text = ("insert", text2) if index1 is None else ("delete", text1)
        return index1, index2, "added" if index1 is None else "removed", text1 or "", text2 or "", [{"op": op, "text": text}]
    alike = difflib.SequenceMatcher(None, text1, text2, autojunk=False).ratio() >= CHANGED
    return index1, index2, "changed" if alike else "replaced", text1, text2, word_ops(text1, text2)


def sequence_diff(first: list[tuple[int, str]], second: list[tuple[int, str]]) -> list[tuple]:
    """(index1, index2, kind, text1, text2, ops) of two ordered lists of paragraphs: pairs within a replaced block by
    place, ``changed`` if their characters are alike enough, else ``replaced``; the rest ``removed`` or ``added``, with one
    op and an empty text on the other side."""
    return [difference(*pair) for pair in unequal(first, second)]


def paragraph_diff(first: DataFrame, second: DataFrame, keys: tuple[str, ...] = ("package_name", "location"), order: str = "para_index", text: str = "accepted") -> DataFrame:
    """(keys..., index1, index2, kind, text1, text2, inline_ops) for every difference within each place.

    All paragraphs of a place are compared as one sequence in one task; the differences found are spread over all
    tasks before their words are compared. Null texts read as empty.
    """
    entry = F.struct(F.col(order).cast("bigint").alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    side = lambda df, n: df.select(*keys, entry.alias("e")).distinct().groupBy(*keys).agg(F.array_sort(F.collect_list("e")).alias(n))
    both = side(first, "a").join(side(second, "b"), [*keys], "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    ops = pa.list_(pa.struct([("op", pa.string()), ("text", pa.string())]))
    found = [("index1", pa.int64()), ("text1", pa.string()), ("index2", pa.int64()), ("text2", pa.string())]
    told = [("index1", pa.int64()), ("index2", pa.int64()), ("kind", pa.string()), ("text1", pa.string()), ("text2", pa.string()), ("inline_ops", ops)]

    def batch_of(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
        schema = pa.schema([*((k, pa.string()) for k in keys), *fields])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * len(schema), schema.types, strict=True)], schema=schema)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *head, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield batch_of([(*head, *pair) for pair in unequal(*([(x["i"], x["t"]) for x in side or []] for side in (a, b)))], found)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_of([(*row[: len(keys)], *difference(*row[len(keys) :])) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)], told)

    names = ", ".join(f"{k} string" for k in keys)
    pairs = both.select(*keys, "a", "b").mapInArrow(match, f"{names}, index1 bigint, text1 string, index2 bigint, text2 string")
    spread = pairs.repartition(int(first.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "index1", "index2")
    return spread.mapInArrow(tell, f"{names}, index1 bigint, index2 bigint, kind string, text1 string, text2 string, inline_ops array<struct<op:string,text:string>>")


# Properties of which the larger value is the newer one, and those of which only equality says something.
ORDERED_SIGNALS = (
    "core.modified", "core.created", "core.revision", "app.TotalTime (edit minutes)", "app.Words", "app.Pages", "app.Characters", "unique w:rsid count", "last tracked-change date", "last comment date", "filesystem mtime",
)
IDENTITY_SIGNALS = ("core.lastModifiedBy", "app.AppVersion")
HASH_SIGNALS = ("archive SHA-256", "normalized document.xml SHA-256")


def signals(first: DataFrame, second: DataFrame, ordered: Sequence[str] = ORDERED_SIGNALS, identity: Sequence[str] = IDENTITY_SIGNALS, hashes: Sequence[str] = HASH_SIGNALS) -> DataFrame:
    """(pair, signal, side): which side of a pair each property (pair, field, value) speaks for, one row for each of them.

    Of ordered ones the larger value wins, the only one there is too; ``tie`` if equal, ``missing`` if neither has it.
    Of identities: ``tie``, ``missing`` or ``n/a``; of hashes: ``tie`` or ``n/a``. Values that read as numbers are compared as such.
    """
    names = F.array(*[F.struct(F.lit(n).alias("field"), F.lit(k).alias("kind")) for k, group in (("ordered", ordered), ("identity", identity), ("hash", hashes)) for n in group])
    pairs = first.select("pair").unionByName(second.select("pair")).distinct().select("pair", F.inline(names))
    for n, side in ((1, first), (2, second)):
        pairs = pairs.join(side.groupBy("pair", "field").agg(F.max("value").alias(f"v{n}")), ["pair", "field"], "left")
    v1, v2 = F.col("v1"), F.col("v2")
    n1, n2 = (v.cast("string").try_cast("double") for v in (v1, v2))
    more = lambda a, b, x, y: F.coalesce(x > y, a > b)
    newer = F.when(v1.isNull() & v2.isNull(), "missing").when(v1.isNull(), "2").when(v2.isNull(), "1").when((v1 == v2) | F.coalesce(n1 == n2, F.lit(False)), "tie").when(more(v1, v2, n1, n2), "1").otherwise("2")
    same = F.when(v1.isNull() & v2.isNull(), "missing").when(v1.eqNullSafe(v2), "tie").otherwise("n/a")
    equal = F.when(v1 == v2, "tie").otherwise("n/a")
    side = F.when(F.col("kind") == "ordered", newer).when(F.col("kind") == "identity", same).otherwise(equal)
    return pairs.select("pair", F.col("field").alias("signal"), side.alias("side"))


def properties_of_package(properties: DataFrame, revisions: DataFrame, comments: DataFrame, files: DataFrame) -> DataFrame:
    """(pair, field, value) of the signals from the views of packages: (doc, category, field, value), (doc, date) twice, and
    (doc, modified, digest) of the files."""
    label = F.concat_ws(".", "category", F.when(F.col("field") == "TotalTime", "TotalTime (edit minutes)").otherwise(F.col("field")))
    own = properties.where(F.col("category").isin("core", "app")).select(F.col("doc").alias("pair"), label.alias("field"), "value")
    body = properties.where("category = 'hash' and field = 'word/document.xml'").select(F.col("doc").alias("pair"), F.lit("normalized document.xml SHA-256").alias("field"), "value")
    saves = properties.where("category = 'rsid'").groupBy(F.col("doc").alias("pair")).agg(F.count_distinct("value").cast("string").alias("value")).withColumn("field", F.lit("unique w:rsid count"))
    dates = [df.groupBy(F.col("doc").alias("pair")).agg(F.max("date").alias("value")).withColumn("field", F.lit(n)) for df, n in ((revisions, "last tracked-change date"), (comments, "last comment date"))]
    stored = files.select(F.col("doc").alias("pair"), F.inline(F.array(F.struct(F.lit("filesystem mtime").alias("field"), F.col("modified").cast("string").alias("value")), F.struct(F.lit("archive SHA-256").alias("field"), F.col("digest").alias("value")))))
    out = own
    for df in (body, saves, *dates, stored):
        out = out.unionByName(df.select("pair", "field", "value"))
    return out.where("value is not null")


def tally(found: DataFrame) -> DataFrame:
    """(pair, first, second, tie, undecided)."""
    count = lambda *s: F.count_if(F.col("side").isin(*s))
    return found.groupBy("pair").agg(count("1").alias("first"), count("2").alias("second"), count("tie").alias("tie"), count("missing", "n/a").alias("undecided"))


def pair_status(texts: Column, metadata: Column, orphan: Column, error: Column | None = None) -> Column:
    """ERROR, ORPHAN, CHANGED, METADATA ONLY or IDENTICAL: an error of either file, a file without partner, then numbers of
    differences."""
    failed = F.coalesce(error, F.lit(False)) if error is not None else F.lit(False)
    return F.when(failed, "ERROR").when(orphan, "ORPHAN").when(texts > 0, "CHANGED").when(metadata > 0, "METADATA ONLY").otherwise("IDENTICAL")


def compare_sets(pairs: DataFrame, first: DataFrame, second: DataFrame, properties: tuple[DataFrame, DataFrame], errors: DataFrame) -> dict[str, DataFrame]:
    """The frames of a comparison of two document sets: ``pairs`` with their status, ``texts``, ``signals`` and ``tally``.

    ``pairs`` is ``pair_files``' frame, ``first`` and ``second`` hold paragraphs (name, location, index, text), ``properties``
    (name, field, value) of each side, ``errors`` (name) of unreadable files. Pairs are named by the first file.
    """
    whole = pairs.where("name1 is not null and name2 is not null").select(F.col("name1").alias("pair"), "name1", "name2")
    side = lambda df, n: df.join(whole.select("pair", F.col(f"name{n}").alias("name")), "name").select("pair", "location", "index", "text")
    texts = paragraph_diff(side(first, 1), side(second, 2), ("pair", "location"), "index", "text")
    props = [df.join(whole.select("pair", F.col(f"name{n}").alias("name")), "name").select("pair", "field", "value") for n, df in ((1, properties[0]), (2, properties[1]))]
    found = signals(*props)
    differ = props[0].withColumnRenamed("value", "v1").join(props[1].withColumnRenamed("value", "v2"), ["pair", "field"], "full_outer").where(~F.col("v1").eqNullSafe(F.col("v2"))).groupBy("pair").agg(F.count(F.lit(1)).alias("metadata"))
    counts = texts.groupBy("pair").agg(F.count(F.lit(1)).alias("texts"))
    bad = errors.select("name").distinct().withColumn("_bad", F.lit(True))
    rows = pairs.withColumn("pair", F.coalesce("name1", "name2")).join(counts, "pair", "left").join(differ, "pair", "left")
    for n in (1, 2):
        rows = rows.join(bad.withColumnsRenamed({"name": f"name{n}", "_bad": f"_bad{n}"}), f"name{n}", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    error = F.coalesce(F.col("_bad1"), F.lit(False)) | F.coalesce(F.col("_bad2"), F.lit(False))
    status = pair_status(n("texts"), n("metadata"), F.col("name1").isNull() | F.col("name2").isNull(), error)
    return {"pairs": rows.select("name1", "name2", "how", status.alias("status"), n("texts").alias("texts"), n("metadata").alias("metadata")), "texts": texts, "signals": found, "tally": tally(found)}
