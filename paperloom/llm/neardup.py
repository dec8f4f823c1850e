"""Near-duplicate texts by deletion-variant signatures over min-hash symbols.

Each text gets ``SEGMENTS * SYMBOLS`` min-hash symbols of its word sequences, cut into ``SEGMENTS`` segments of
``SYMBOLS``. Two texts of similarity s agree in each symbol with probability s, so for similar texts some segment
differs in at most one symbol. For every segment all variants with one symbol deleted are indexed: equal variants
mean that the segment differs in at most that symbol. Texts that share a variant are candidates; a sketch of two
bits for each of 64 symbols, sent along, drops nearly all chance meetings; what is left is verified on the texts.

Only rows of bytes, one for each (block of texts, part of the index), are shuffled. Copies of a text are one text:
they carry one id, so a text that a third of all rows repeat is indexed once for each task that meets it. The number
of parts follows from the number of texts, so that a part is of one size however large the table is; a part that
is far larger all the same (one family of texts) is cut into blocks that meet pairwise in tasks of their own. The
members of a text with very many copies are cut into blocks before they are paired.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.groups import components
from paperloom.llm.lookalikes import visible
from paperloom.session import free_shuffles, materialize

#: Segments and symbols in each: at similarity 0.6 a segment differs in at most one of 4 symbols with probability
#: 0.475, so that 12 segments miss a pair with probability 0.0005 (0.000003 at 0.7).
SEGMENTS, SYMBOLS = 12, 4
#: Symbols of the sketch and how many must agree: at similarity 0.6 a symbol's two bits agree with probability
#: 0.7, fewer than 33 of 64 do with probability 0.0006; of unlike texts 0.000001 have as many.
SKETCH, AGREE = 64, 33
#: Planes of the sketch, bytes of a variant's hash beside the part it is in (parts get no larger, so the hash is wide
#: enough for any number of texts), bytes of an id (texts that share one are all kept, so it only must be rarely shared),
#: and bytes of a text in one half of a segment: id, sketch and two variants.
PLANES, VARIANT_BYTES, ID_BYTES = 2, 3, 6
ENTRY = ID_BYTES + 8 * PLANES + 2 * VARIANT_BYTES
#: Bytes of a part of the index: the least and the most, and the number of parts from which they grow.
PART_BYTES, LARGEST_PART, MANY_PARTS = 8 << 20, 64 << 20, 10_000
#: Parts of so many times the usual size are cut into blocks.
OVERSIZE = 4
#: Bits of the filter that keeps texts without candidates out of the verification: the least and the most (32 MB).
#: Beyond some 300 million marked rows it lets nearly all texts pass, which costs time but no pair.
FILTER_BITS, MOST_FILTER_BITS = 1 << 25, 1 << 28
#: Copies of a text up to which they are paired in one task, and the most texts that may have more (they are broadcast).
COPIES, MOST_HOT = 2_000, 50_000
#: Parts over which the members of texts are spread.
MEMBER_PARTS = 960
#: Texts that one row of bytes of the index holds at most.
BLOCK = 2_000
#: Of the sketch's first bits, how many may differ: at similarity 0.6 more do with probability 0.00001.
FIRST_BITS = 26
#: Candidate pairs handed on at once.
PAIR_BLOCK = 400_000

_WORDS = re.compile(r"[^\W_]+").findall
#: Letters and digits of the first 256 characters as they are, a blank for any other.
_LATIN_1 = bytes(k if chr(k).isalnum() else 32 for k in range(256))
_RNG = np.random.default_rng(20_240_117)
_XOR = _RNG.integers(0, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + _RNG.integers(0, 2, SKETCH, dtype=np.uint64)
_MUL = _RNG.integers(0, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


@lru_cache(maxsize=1)
def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0xD6E8FEB86659FD93
    return tuple(np.cumprod(np.full(size, x, np.uint64), dtype=np.uint64) for x in (base, pow(base, -1, 1 << 64)))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 to the 64."""
    return _power_table(1 << max(18, int(size).bit_length()))


def words_of(text: str | None, least: int) -> str | None:
    """The words of a text as it looks, in lower case, with one blank between; None for fewer than ``least`` words."""
    if not text:
        return None
    low = visible(text).lower()
    try:
        row = low.encode("latin-1").translate(_LATIN_1).strip()
        while b"  " in row:
            row = row.replace(b"  ", b" ")
        words = row.decode("latin-1")
    except UnicodeEncodeError:
        words = " ".join(_WORDS(low))
    return words if words and words.count(" ") + 1 >= least else None


def text_digest(words: str) -> bytes:
    """128 bits that stand for a sequence of words; the first 48 are its id in the index."""
    return xxhash.xxh3_128_digest(words)


def _ids(digests: list[bytes]) -> np.ndarray:
    """Ids of texts. Two texts may share one: the index keeps both, and pairs are joined to all texts of an id."""
    return np.frombuffer(b"".join(digests), np.int64)[::2] & ((1 << 8 * ID_BYTES) - 1)


def _sequences(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all sequences of ``size`` words of all texts, and where each text starts.

    The words of all texts lie in one row of bytes; a word's hash is a polynomial of its bytes.
    """
    row = np.frombuffer("\n".join(texts).encode("utf-8", "surrogatepass"), np.uint8)
    power, inverse = _powers(len(row) + 1)
    total = np.zeros(len(row) + 1, np.uint64)
    np.cumsum(row * power[: len(row)], out=total[1:])
    ends = np.append(np.flatnonzero(row <= 32), len(row))
    begins = np.concatenate(([0], ends[:-1] + 1))
    h = (total[ends] - total[begins]) * inverse[begins]
    h = (h ^ (h >> np.uint64(31))) * _MIX[2]
    counts = np.fromiter((t.count(" ") + 1 for t in texts), np.int64, len(texts))
    starts = np.cumsum(counts) - counts
    n = len(h) - size + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(size):
        mixed = mixed * _MIX[0] + h[k : k + n] * _MIX[1 + k % 3]
        mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX[3]
    mixed ^= mixed >> np.uint64(32)
    keep = np.ones(len(h), bool)
    for k in range(1, size):
        keep[starts + counts - k] = False
    return mixed[keep[:n]], starts - (size - 1) * np.arange(len(texts))


def _symbols(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Min-hash symbols, one row for each of ``SKETCH`` functions."""
    out = np.empty((SKETCH, len(starts)), np.uint64)
    for f in range(SKETCH):
        out[f] = np.minimum.reduceat((hashes ^ _XOR[f]) * _MUL[f], starts)
    out ^= out >> np.uint64(31)
    out *= _MIX[0]
    out ^= out >> np.uint64(29)
    return out


def _planes(symbols: np.ndarray) -> np.ndarray:
    """Two bits of each symbol as words of 64 bits for each text."""
    out = np.zeros((symbols.shape[1], PLANES), np.uint64)
    for plane in range(PLANES):
        for f in range(SKETCH):
            out[:, plane] |= ((symbols[f] >> np.uint64(40 + plane)) & np.uint64(1)) << np.uint64(f)
    return out


def _variants(symbols: np.ndarray, segment: int) -> np.ndarray:
    """Hashes of the segment with each of its symbols deleted: one row for each symbol."""
    rows = symbols[segment * SYMBOLS : (segment + 1) * SYMBOLS]
    out = np.empty((SYMBOLS, rows.shape[1]), np.uint64)
    for gone in range(SYMBOLS):
        h = np.full(rows.shape[1], gone + 1, np.uint64)
        for k in range(SYMBOLS):
            if k != gone:
                h = (h ^ rows[k]) * _MIX[k % 4]
                h ^= h >> np.uint64(32)
        out[gone] = h
    return out


def _index(least: int, size: int, buckets: int):
    """Texts (field, text, key) to rows (part, bytes).

    Parts from 0 hold ids, sketches and variants of texts; negative parts hold the texts' members: field, key and
    digest of every row.
    """
    many = min(10_000, max(BLOCK, 50 * buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, bytes]] = set()
        for batch in batches:
            fields, texts, keys = (batch.column(k).to_pylist() for k in range(3))
            rows = [(f, w, k) for f, t, k in zip(fields, texts, keys, strict=True) if (w := words_of(t, least)) is not None]
            if not rows:
                continue
            digests = [text_digest(w) for _, w, _ in rows]
            packed = np.array([f for f, _, _ in rows], np.int64).tobytes() + np.array([k for _, _, k in rows], np.int64).tobytes() + b"".join(digests)
            yield _rows([-1 - xxhash.xxh3_64_intdigest(digests[0]) % MEMBER_PARTS], [packed])
            new = [(f, w, d) for (f, w, _), d in zip(rows, digests, strict=True) if (f, d) not in seen]
            if len(seen) < 1_000_000:  # beyond that, copies are found where the parts of the index meet
                seen.update((f, d) for f, _, d in new)
            for at in range(0, len(new), many):
                block = new[at : at + many]
                pieces = [_symbols(*_sequences([w for _, w, _ in block[k : k + 250]], size)) for k in range(0, len(block), 250)]  # arrays that fit into a cache
                yield _parts(np.array([f for f, _, _ in block]), _ids([d for _, _, d in block]), np.concatenate(pieces, axis=1), buckets)

    return run


def _rows(part: list[int], payload: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(payload, pa.binary())], names=["part", "payload"])


def _parts(kind: np.ndarray, ids: np.ndarray, symbols: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row of bytes for each part. A variant without one of a segment's last two symbols has the first two, and the
    other way round: these two choose the bucket, so that a text is in two buckets of a segment and not in four."""
    planes = _planes(symbols)
    part, payload = [], []
    fields = [(int(f), np.flatnonzero(kind == f)) for f in np.unique(kind)]
    for segment in range(SEGMENTS):
        short = (_variants(symbols, segment) >> np.uint64(40)).astype(np.uint32)
        for half in (0, 1):
            kept = symbols[segment * SYMBOLS + 2 * half], symbols[segment * SYMBOLS + 2 * half + 1]
            bucket = (((kept[0] ^ _MIX[1]) * _MIX[0] ^ kept[1]) * _MIX[2] >> np.uint64(33)) % np.uint64(buckets)
            variants = np.stack(short[2 - 2 * half : 4 - 2 * half], axis=1)
            for field, mine in fields:
                order = mine[np.argsort(bucket[mine], kind="stable")] if buckets > 1 else mine
                for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                    part.append(((field * SEGMENTS + segment) * 2 + half) * buckets + int(bucket[own[0]]))
                    payload.append(_packed(ids[own], planes[own], variants[own]))
    return _rows(part, payload)


def _packed(ids: np.ndarray, planes: np.ndarray, variants: np.ndarray) -> bytes:
    """Bytes: ids, sketches and both variants of each text."""
    low = np.ascontiguousarray(variants).view(np.uint8).reshape(-1, 4)[:, :VARIANT_BYTES]
    return b"".join((np.ascontiguousarray(ids).view(np.uint8).reshape(-1, 8)[:, :ID_BYTES].tobytes(), planes.tobytes(), low.tobytes()))


def _unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(payload) // ENTRY
    ids, raw = np.zeros((n, 8), np.uint8), np.zeros((2 * n, 4), np.uint8)
    ids[:, :ID_BYTES] = np.frombuffer(payload, np.uint8, n * ID_BYTES).reshape(n, ID_BYTES)
    raw[:, :VARIANT_BYTES] = np.frombuffer(payload, np.uint8, 2 * n * VARIANT_BYTES, n * (ID_BYTES + 8 * PLANES)).reshape(2 * n, VARIANT_BYTES)
    return ids.view(np.int64).ravel(), np.frombuffer(payload, np.uint64, n * PLANES, ID_BYTES * n).reshape(n, PLANES), raw.view(np.uint32).reshape(n, 2)


def _meetings(payloads: list[bytes], sides: list[int] | None = None) -> Iterator[np.ndarray]:
    """Pairs of ids of one part that share a variant and whose sketches agree, in blocks.

    With ``sides``, one number for each payload, only pairs from different sides. A copy of a text (same id, sketch and
    variants) is left out; different texts that share an id are kept and may come out as a pair of equal ids.
    """
    pieces = [_unpacked(p) for p in payloads]
    ids, planes, short = (np.concatenate([p[k] for p in pieces]) for k in range(3))
    side = np.repeat(sides or [0] * len(pieces), [len(p[0]) for p in pieces])
    order = np.argsort(ids, kind="stable")
    ids, planes, short, side = ids[order], planes[order], short[order], side[order]
    copy = (ids[1:] == ids[:-1]) & (planes[1:] == planes[:-1]).all(axis=1) & (short[1:] == short[:-1]).all(axis=1) & (side[1:] == side[:-1])
    first = np.flatnonzero(np.append(True, ~copy))
    ids, planes, short, side = ids[first], np.ascontiguousarray(planes[first].T), short[first], side[first]
    for gone in (0, 1):
        order = np.argsort(short[:, gone], kind="stable")
        key = short[order, gone]
        if len(key) < 2:
            continue
        x, y, z = planes[0][order], planes[1][order], side[order]  # in the order of the runs, so that runs lie together
        last = np.flatnonzero(np.append(key[1:] != key[:-1], True))
        left = np.repeat(last, np.diff(np.concatenate(([-1], last)))) - np.arange(len(key))  # entries of the run that follow
        active, step = np.flatnonzero(left > 0), 1
        while len(active):
            for at in range(0, len(active), PAIR_BLOCK):
                a = active[at : at + PAIR_BLOCK]
                differ = np.take(x, a) ^ np.take(x, a + step)
                close = np.flatnonzero(np.bitwise_count(differ) <= FIRST_BITS)
                a, differ = a[close], differ[close]
                b = a + step
                differ |= np.take(y, a) ^ np.take(y, b)
                good = np.bitwise_count(differ) <= SKETCH - AGREE
                if sides:
                    good &= np.take(z, a) != np.take(z, b)
                if good.any():
                    yield np.stack([ids[order[a[good]]], ids[order[b[good]]]], axis=1)
            step += 1
            active = active[left[active] >= step]


#: What a row of the index's result is: a pair of ids, a member (key, id, digest), or a piece of a part that is to be cut.
PAIR, MEMBER, PIECE = 0, 1, 2
_FOUND = "kind int, field int, a bigint, b bigint, digest binary"


def _batch(kind: int, field, a: np.ndarray, b: np.ndarray, digests: list[bytes] | None = None) -> pa.RecordBatch:
    column = pa.nulls(len(a), pa.binary()) if digests is None else pa.array(digests, pa.binary())
    whole = lambda x: pa.array(np.broadcast_to(np.asarray(x, np.int32), len(a)).copy())
    return pa.RecordBatch.from_arrays([whole(kind), whole(field), pa.array(a), pa.array(b), column], names=["kind", "field", "a", "b", "digest"])


def _members(payload: bytes) -> pa.RecordBatch:
    n = len(payload) // 32
    field, key = np.frombuffer(payload, np.int64, n), np.frombuffer(payload, np.int64, n, 8 * n)
    digests = [payload[16 * n + 16 * k : 16 * n + 16 * k + 16] for k in range(n)]
    return _batch(MEMBER, field, key, _ids(digests), digests)


def _pairs(field: int, payloads: list[bytes], sides: list[int] | None = None) -> Iterator[pa.RecordBatch]:
    kept: list[np.ndarray] = []

    def out() -> pa.RecordBatch:
        pairs = np.unique(np.sort(np.concatenate(kept), axis=1), axis=0)
        kept.clear()
        return _batch(PAIR, field, np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1]))

    for block in _meetings(payloads, sides):
        kept.append(block)
        if sum(map(len, kept)) > PAIR_BLOCK:
            yield out()
    if kept:
        yield out()


def _candidates(per_field: int, most: int):
    """Rows (part, bytes), sorted by part, to candidate pairs (field, a, b), members (field, key, id, digest) and, of
    parts of more than ``most`` bytes, pieces (part, block, -, bytes): no more than that is held at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block, held = None, 0, 0
        payloads: list[bytes] = []

        def done(whole: bool) -> Iterator[pa.RecordBatch]:
            if whole and not block:
                yield from _pairs(at // per_field, payloads)
            else:
                yield _batch(PIECE, at, np.full(len(payloads), block), np.zeros(len(payloads), np.int64), payloads)

        for batch in batches:
            for part, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part < 0:
                    yield _members(payload)
                    continue
                if payloads and (part != at or held + len(payload) > most):
                    yield from done(part != at)
                    block, payloads, held = block + 1, [], 0
                if part != at:
                    at, block = part, 0
                payloads.append(payload)
                held += len(payload)
        if payloads:
            yield from done(True)

    return run


def _met_blocks(per_field: int):
    """Rows (part, low, high, block, bytes), sorted, to the pairs within a block or, of two blocks, between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for (part, low, high), unit in groupby(rows, lambda r: r[:3]):
            held = list(unit)
            yield from _pairs(part // per_field, [r[4] for r in held], None if low == high else [r[3] for r in held])

    return run


def indexed(texts: DataFrame, least: int, size: int, part_bytes: int | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(candidates, members, rows) of ``texts`` (field int, text string, key bigint), from one pass over the texts.

    Candidates (field, a, b), a <= b, some of them more than once, are ids of texts of one field that share a deletion
    variant and agree in their sketch; members (field, key, id, digest) have every row that has enough words; ``rows``
    is the number of rows given. A part of the index is a bucket of the variants of half a segment of one field; there
    are as many buckets and partitions as keep a part at ``part_bytes`` (default: ``PART_BYTES``, more where there would
    be over ``MANY_PARTS`` partitions). Pieces of oversized parts meet block by block. Results are written once into the
    shared folder, as later steps read them more than once.
    """
    spark = texts.sparkSession
    rows = texts.count()
    whole = rows * 2 * SEGMENTS * ENTRY
    goal = part_bytes or min(LARGEST_PART, max(PART_BYTES, whole // MANY_PARTS))
    buckets = max(1, -(-rows * ENTRY // goal))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-whole // goal))
    per_field = 2 * SEGMENTS * buckets
    index = texts.select("field", "text", "key").mapInArrow(_index(least, size, buckets), "part int, payload binary")
    spread = index.repartitionById(partitions, F.pmod("part", F.lit(partitions))).sortWithinPartitions("part")
    found = materialize(spread.mapInArrow(_candidates(per_field, OVERSIZE * goal), _FOUND))
    pieces = found.where(F.col("kind") == PIECE).select(F.col("field").alias("part"), F.col("a").alias("block"), F.col("digest").alias("payload"))
    pairs = found.where(F.col("kind") == PAIR).select("field", "a", "b")
    if not pieces.isEmpty():
        sizes = pieces.groupBy("part").agg(F.max("block").alias("last"))
        units = pieces.join(sizes, "part").select("part", "block", "payload", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")).alias("other"))
        units = units.select("part", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "payload")
        met = units.repartition(partitions, "part", "low", "high").sortWithinPartitions("part", "low", "high").mapInArrow(_met_blocks(per_field), _FOUND)
        pairs = pairs.unionByName(materialize(met).select("field", "a", "b"))
    return pairs, found.where(F.col("kind") == MEMBER).select("field", F.col("a").alias("key"), F.col("b").alias("id"), "digest"), rows


def _filter_bits(rows: int) -> int:
    """Bits of the filter for so many rows: a power of two, eight a row, within its limits."""
    return min(MOST_FILTER_BITS, max(FILTER_BITS, 1 << (8 * rows).bit_length()))


def _place(field, key, size: int):
    return F.pmod(F.xxhash64(field, key), F.lit(size)).cast("bigint")


def _filter_of(rows: DataFrame, size: int) -> bytes:
    """A bit for the place of each row (field, key), in ``size`` bits whatever the number of rows."""
    place = _place("field", "key", size) + 1  # the bitmap functions count from 1
    bits = rows.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(size // 8, np.uint8)
    for r in bits.collect():  # at most size / 32768 rows of 4 KB
        out[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes()


def _chosen(least: int, marked):
    """Texts (field, text, place) to (field, id, digest, words) of those whose place is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(marked.value, np.uint8)
        for batch in batches:
            place = batch.column(2).to_numpy()
            mine = batch.filter(pa.array((bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)))
            words = [words_of(t, least) for t in mine.column(1).to_pylist()]
            mine = mine.filter(pa.array([w is not None for w in words], pa.bool_()))
            words = [w for w in words if w is not None]
            digests = [text_digest(w) for w in words]
            yield pa.RecordBatch.from_arrays([mine.column(0), pa.array(_ids(digests)), pa.array(digests, pa.binary()), pa.array(words, pa.string())], names=["field", "id", "digest", "words"])

    return run


def _verified(size: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[bytes, set[int]] = {}
        for batch in batches:
            if len(sets) > 20_000:
                sets.clear()
            digests, texts = ([*batch.column(k).to_pylist(), *batch.column(k + 1).to_pylist()] for k in (1, 3))
            new = {d: t for d, t in zip(digests, texts, strict=True) if d not in sets}
            names, words = list(new), list(new.values())
            for at in range(0, len(names), 250):
                hashes, starts = _sequences(words[at : at + 250], size)
                ends = np.append(starts[1:], len(hashes)).tolist()
                flat = hashes.tolist()
                for name, begin, end in zip(names[at : at + 250], starts.tolist(), ends, strict=True):
                    sets[name] = set(flat[begin:end])
            keep = []
            for da, db in zip(digests[: batch.num_rows], digests[batch.num_rows :], strict=True):
                one, two = sets[da], sets[db]
                both = len(one & two)
                keep.append(both >= threshold * (len(one) + len(two) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays(batch.columns[:3], names=["field", "digest_a", "digest_b"]).filter(pa.array(keep, pa.bool_()))

    return run


def similar_texts(texts: DataFrame, candidates: DataFrame, members: DataFrame, rows: int, least: int, size: int, threshold: float) -> DataFrame:
    """Rows (field, digest_a, digest_b): candidates that are different texts whose similarity reaches the threshold.

    For every text that has candidates one row is chosen; a filter of bounded size picks the chosen rows' texts where
    they are read, so that the other texts are neither shuffled nor parsed again.
    """
    bits = _filter_bits(rows)
    candidates = materialize(candidates.distinct())
    ids = candidates.select("field", F.explode(F.array("a", "b")).alias("id")).distinct()
    chosen = members.groupBy("field", "digest").agg(F.min("key").alias("key"), F.first("id").alias("id")).join(ids, ["field", "id"], "left_semi")
    marked = texts.sparkSession.sparkContext.broadcast(_filter_of(chosen, bits))
    free_shuffles(texts.sparkSession)
    said = texts.select("field", "text", _place("field", "key", bits).alias("place")).mapInArrow(_chosen(least, marked), "field int, id bigint, digest binary, words string")
    said = said.dropDuplicates(["field", "digest"])
    a = said.select("field", F.col("id").alias("a"), F.col("digest").alias("digest_a"), F.col("words").alias("words_a"))
    b = said.select("field", F.col("id").alias("b"), F.col("digest").alias("digest_b"), F.col("words").alias("words_b"))
    met = candidates.join(a, ["field", "a"]).join(b, ["field", "b"])
    met = met.where((F.col("a") != F.col("b")) | (F.col("digest_a") < F.col("digest_b"))).select("field", "digest_a", "digest_b", "words_a", "words_b")
    return met.mapInArrow(_verified(size, threshold), "field int, digest_a binary, digest_b binary")


def hot_texts(members: DataFrame, rows: int, copies: int = COPIES) -> tuple[DataFrame, int]:
    """(field, digest, blocks) of the texts with more copies than may be paired in one task, and that number: at least
    ``copies``, and so many that no more than ``MOST_HOT`` texts can have more, so that the result may be broadcast."""
    most = max(copies, rows // MOST_HOT)
    many = members.groupBy("field", "digest").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    return many.select("field", "digest", F.ceil(F.col("n") / copies).cast("int").alias("blocks")), most


def in_blocks(members: DataFrame, hot: DataFrame) -> DataFrame:
    """Members with the block of their text's copies that they are in, one block for all but hot texts."""
    joined = members.join(F.broadcast(hot), ["field", "digest"], "left")
    return joined.select("field", "digest", "key", F.pmod(F.xxhash64("key"), F.coalesce("blocks", F.lit(1))).cast("int").alias("block"))


def _every_block(rows: DataFrame, hot: DataFrame, side: str) -> DataFrame:
    """Each row once for every block of the text ``digest_<side>``."""
    blocks = F.broadcast(hot.select(F.col("field"), F.col("digest").alias(f"digest_{side}"), "blocks"))
    return rows.join(blocks, ["field", f"digest_{side}"], "left").withColumn(f"block_{side}", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))).drop("blocks")


def similar_records(texts: DataFrame, least: int = 8, size: int = 3, threshold: float = 0.6, copies: int = COPIES, part_bytes: int | None = None) -> DataFrame:
    """Rows (field, key_1, key_2), key_1 < key_2: records of one field that are alike; equal texts are, too.

    ``texts`` has (field int, text string, key bigint). The similarity of two texts is the number of distinct
    sequences of ``size`` consecutive words that both have, divided by the number that either has, on the words as
    they look and in lower case. Null texts and texts of fewer than ``least`` words (at least ``size``) are in no
    pair. A record that is delivered twice should be given once. Copies of a text are paired in blocks of ``copies``,
    ``part_bytes`` is the size of a part of the index; neither changes the result.
    """
    candidates, members, rows = indexed(texts, max(least, size), size, part_bytes)
    near = similar_texts(texts, candidates, members, rows, max(least, size), size, threshold)
    hot = materialize(hot_texts(members, rows, copies)[0])
    blocks = in_blocks(members, hot).repartition("field", "digest", "block")
    one = blocks.select("field", F.col("digest").alias("digest_a"), F.col("block").alias("block_a"), F.col("key").alias("key_a"))
    two = blocks.select("field", F.col("digest").alias("digest_b"), F.col("block").alias("block_b"), F.col("key").alias("key_b"))
    links = _every_block(_every_block(near, hot, "a"), hot, "b")
    between = _every_block(_every_block(hot.select("field", F.col("digest").alias("digest_a"), F.col("digest").alias("digest_b")), hot, "a"), hot, "b").where("block_a < block_b")
    different = links.unionByName(between).join(one, ["field", "digest_a", "block_a"]).join(two, ["field", "digest_b", "block_b"])
    same = two.withColumnsRenamed({"digest_b": "digest_a", "block_b": "block_a"})
    equal = one.join(same, ["field", "digest_a", "block_a"]).where("key_a < key_b")
    pairs = different.select("field", "key_a", "key_b").unionByName(equal.select("field", "key_a", "key_b"))
    return pairs.select("field", F.least("key_a", "key_b").alias("key_1"), F.greatest("key_a", "key_b").alias("key_2"))


def similar_groups(texts: DataFrame, least: int = 8, size: int = 3, threshold: float = 0.6, copies: int = COPIES) -> DataFrame:
    """Rows (field, key, group_key, links): the group of every record that is alike to another, by its least key, and
    the number of records that it is alike to itself. Records without such a partner have no row; see
    ``similar_records`` for what is alike. Links are found between different texts only; copies are members of theirs.
    """
    candidates, members, rows = indexed(texts, max(least, size), size)
    near = materialize(similar_texts(texts, candidates, members, rows, max(least, size), size, threshold))
    roots = components(near, "field", "digest_a", "digest_b").withColumnRenamed("node", "digest")
    counts = members.groupBy("field", "digest").agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("least_key"))
    both = near.unionByName(near.select("field", F.col("digest_b").alias("digest_a"), F.col("digest_a").alias("digest_b")))
    other = counts.select("field", F.col("digest").alias("digest_b"), F.col("copies").alias("near"))
    degree = both.join(other, ["field", "digest_b"]).groupBy("field", F.col("digest_a").alias("digest")).agg(F.sum("near").alias("near"))
    classes = counts.join(roots, ["field", "digest"], "left").join(degree, ["field", "digest"], "left")
    classes = classes.select("field", "digest", F.coalesce("root", "digest").alias("root"), "least_key", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("links")).where("links > 0")
    first = classes.groupBy("field", "root").agg(F.min("least_key").alias("group_key"))
    classes = classes.join(first, ["field", "root"]).select("field", F.col("digest").alias("digest_a"), "group_key", "links")
    hot = materialize(hot_texts(members, rows, copies)[0])
    named = _every_block(classes, hot, "a").withColumnsRenamed({"digest_a": "digest", "block_a": "block"})
    return in_blocks(members, hot).join(named, ["field", "digest", "block"]).select("field", "key", "group_key", "links")


FIELDS = ("control_description", "supplemental_guidance")


def control_texts(control_row: DataFrame) -> DataFrame:
    """Rows (field, text, key) of both fields of control_row; a repeated row counts once."""
    return control_row.select(
        F.col("row_id").cast("bigint").alias("key"), F.inline(F.array(*[F.struct(F.lit(k).alias("field"), F.col(c).alias("text")) for k, c in enumerate(FIELDS)]))
    ).select("field", "text", "key").where(F.length("text") > 0)


def field_name(field: str = "field"):
    return F.element_at(F.array(*[F.lit(x) for x in FIELDS]), F.col(field) + 1).alias("field_name")
