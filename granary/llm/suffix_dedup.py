"""Removal of repeated substrings with suffix arrays built by two-stage sorting.

A string of `length` bytes that stands in two places is looked at, in both, from the same anchor: the position with the
least hash of `length // 2` bytes among all in it. Anchors, not texts, are counted over the corpus; only the bytes
around anchors whose hash occurs again are sorted, a copy of each distinct stretch. In a sorting task the suffixes that
are smaller than their successors are sorted directly, the rest is induced by scanning the buckets of first bytes, and
the common prefixes of neighbours tell which strings occur again. An anchor with very many distinct stretches (a passage
that very many documents quote) is not sorted in one task: its strings are counted one by one instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import UNIT_BYTES, collect_garbage, input_bytes, new_id, pick, pooled, release_memory, root_sized, stage, stage_by, table
from granary.llm.hashing import mix, pack, pack_sorted, runs, spans, unpack, unpack_sorted

LENGTH = 400
#: Bytes of texts of a chunk, and anchors whose hashes one task counts, about: the least and the most.
CHUNK_BYTES, MOST_CHUNK_BYTES = 4 << 20, 10 << 20
ANCHORS_PER_RANGE, MOST_PER_RANGE = 20_000, 64_000
#: Anchors that one sorting task handles, about.
ANCHORS_PER_SORT = 20_000
#: Anchors in a table of UNIT_BYTES, about.
UNIT_ANCHORS = 1_700_000
#: Distinct stretches of one anchor that are sorted together.
MOST_STRETCHES = 256
NULL_ID = -(1 << 63)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: The second hash reads bytes through this table.
_SPREAD = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_to(n: int, base: int = _BASES[0]) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if base not in _powers or len(_powers[base][0]) < n:
        out = []
        for x in (base, pow(base, -1, 1 << 64)):
            step = np.full(max(n, 1 << 16), x, np.uint64)
            step[0] = 1
            out.append(np.cumprod(step, dtype=np.uint64))
        _powers[base] = (out[0], out[1])
    return _powers[base]


class Anchors:
    """The anchors of one text: for each, the starts first..last of the strings it serves.

    hash: of the bytes at the anchor. digest: of all bytes of those strings and the anchor's place among them.
    """

    def __init__(self, raw: bytes, length: int):
        n, k = len(raw), max(1, length // 2)
        self.raw, self.length = raw, length
        if n < length:
            self.first = self.last = np.zeros(0, np.int64)
            self.hash = self.digest = np.zeros(0, np.uint64)
            return
        power, inverse = _powers_to(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)) * power[:n], out=self.sums[1:])
        h = mix((self.sums[k:] - self.sums[:-k]) * inverse[: n - k + 1])
        w, windows = length - k + 1, n - length + 1
        least, span = (h & _HIGH) | np.arange(len(h), dtype=np.uint64), 1
        while 2 * span <= w:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[:windows], least[w - span : w - span + windows]) & _LOW
        change = np.flatnonzero(np.diff(least)) + 1
        self.first = np.concatenate(([0], change)).astype(np.int64)
        self.last = np.concatenate((change - 1, [windows - 1])).astype(np.int64)
        at = least[self.first].astype(np.int64)
        self.hash = mix(h[at])  # the least of many are small: spread them over the ranges
        whole = (self.sums[self.last + length] - self.sums[self.first]) * inverse[self.first]
        self.digest = mix(mix(whole) ^ ((self.last - self.first).astype(np.uint64) << np.uint64(32)) ^ (at - self.first).astype(np.uint64))

    def strings(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit hashes of each of the strings that anchor i serves."""
        a, b = int(self.first[i]), int(self.last[i]) + 1
        _, inverse = _powers_to(len(self.raw) + 1)
        h = (self.sums[a + self.length : b + self.length] - self.sums[a:b]) * inverse[a:b]
        raw = np.frombuffer(self.raw, np.uint8)[a : b - 1 + self.length]
        power, inverse = _powers_to(len(raw) + 1, _BASES[1])
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_SPREAD[raw] * power[: len(raw)], dtype=np.uint64)))
        other = (sums[self.length :] - sums[: -self.length]) * inverse[: b - a]
        return mix(h), mix(other)


def two_stage_suffixes(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions of text in the order of their suffixes, compared up to depth bytes at least.

    Zeros end a stretch and are smaller than every byte. Suffixes smaller than their successors (type B) are sorted
    directly; a suffix greater than its successor (type A) goes, within the bucket of its first byte and before the
    bucket's B suffixes, by the place of its successor, which a scan of the buckets from the least byte up has set.
    """
    n, every = len(text), np.arange(len(text), dtype=np.int32)
    step = np.zeros(n, np.int8)
    step[:-1] = (text[1:] > text[:-1]).astype(np.int8) - (text[1:] < text[:-1])
    step[-1] = -1
    decided = np.minimum.accumulate(np.where(step != 0, every, n - 1)[::-1])[::-1]
    is_b = step[decided] > 0
    next_b = np.minimum.accumulate(np.where(is_b | (text == 0), every, n - 1)[::-1])[::-1]
    # Wanted suffixes and the successors that induce them.
    active = np.zeros(n + 1, np.int32)
    np.add.at(active, wanted, 1)
    np.add.at(active, next_b[wanted] + 1, -1)
    active = np.flatnonzero(np.cumsum(active[:-1]) > 0)
    direct = active[is_b[active] | (text[active] == 0)]
    direct = _sorted_directly(text, direct, depth)
    induced = active[~is_b[active] & (text[active] != 0)]
    rank, out, placed = np.zeros(n, np.int32), [], 0

    def place(positions: np.ndarray) -> None:
        nonlocal placed
        rank[positions] = np.arange(placed, placed + len(positions))
        placed += len(positions)
        out.append(positions)

    equal = decided[induced] - induced  # equal bytes after it before a smaller one
    order = np.lexsort((equal, text[induced]))
    induced, equal = induced[order], equal[order]
    bucket = text[induced].astype(np.int64) << 40 | equal
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    heads = text[direct]
    cuts = np.searchsorted(heads, np.arange(257))
    at = 0
    for byte in range(256):
        while at < len(edges) and text[induced[edges[at]]] == byte:
            some = induced[edges[at] : edges[at + 1] if at + 1 < len(edges) else len(induced)]
            place(some[np.argsort(rank[some + 1], kind="stable")])
            at += 1
        place(direct[cuts[byte] : cuts[byte + 1]])
    suffixes = np.concatenate(out)
    keep = np.zeros(n, bool)
    keep[wanted] = True
    return suffixes[keep[suffixes]]


def _words_of(text: np.ndarray) -> np.ndarray:
    """Eight bytes from each position, zeros behind the end."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    return np.lib.stride_tricks.as_strided(padded, (len(text) + 1, 8), (1, 1))


def _sorted_directly(text: np.ndarray, positions: np.ndarray, depth: int) -> np.ndarray:
    """By the first 16 bytes in numpy, and what is equal there by the rest."""
    if not len(positions):
        return positions
    eight = _words_of(text)
    key = lambda p: np.ascontiguousarray(eight[np.minimum(p, len(text))]).view(">u8").ravel().astype(np.uint64)
    first, second = key(positions), key(positions + 8)
    order = np.lexsort((second, first))
    positions, first, second = positions[order], first[order], second[order]
    same = (first[1:] == first[:-1]) & (second[1:] == second[:-1])
    starts = np.flatnonzero(same & ~np.concatenate(([False], same[:-1])))
    ends = np.flatnonzero(same & ~np.concatenate((same[1:], [False]))) + 2
    raw = text.tobytes()
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        positions[a:b] = sorted(positions[a:b].tolist(), key=lambda p: raw[p + 16 : p + depth])
    return positions


def common_prefixes(text: np.ndarray, suffixes: np.ndarray, most: int) -> np.ndarray:
    """For each suffix after the first, how many bytes it shares with the one before, up to most."""
    eight = _words_of(text)
    lcp = np.zeros(max(0, len(suffixes) - 1), np.int64)
    left = np.arange(len(lcp))
    word = lambda p: np.ascontiguousarray(eight[np.minimum(p, len(text))]).view("<u8").ravel()
    for at in range(0, most, 8):
        if not len(left):
            break
        differ = word(suffixes[left] + at) ^ word(suffixes[left + 1] + at)
        low = differ & (~differ + np.uint64(1))
        lcp[left] += np.where(differ == 0, 8, np.where(low > 0, np.log2(np.maximum(low, 1).astype(np.float64)), 0).astype(np.int64) // 8)
        left = left[differ == 0]
    return np.minimum(lcp, most)


def repeated_starts(stretches: list[bytes], starts: list[int], length: int) -> list[np.ndarray]:
    """For each stretch, which of its first `starts` positions begin a string of `length` bytes that another wanted position begins too."""
    cuts = np.cumsum([0, *(len(s) + 1 for s in stretches)])
    text = np.frombuffer(b"\0".join(s.translate(_UP) for s in stretches) + b"\0", np.uint8)
    wanted = np.concatenate([np.arange(c, c + n) for c, n in zip(cuts, starts)])  # noqa: B905
    suffixes = two_stage_suffixes(text, wanted, length)
    long = common_prefixes(text, suffixes, length) >= length
    again = np.zeros(len(text), bool)
    again[suffixes[1:][long]] = True
    again[suffixes[:-1][long]] = True
    return [again[c : c + n] for c, n in zip(cuts, starts)]  # noqa: B905


#: Bytes moved up by one, so that 0 ends a stretch; UTF-8 has no byte 255.
_UP = bytes(min(255, b + 1) for b in range(256))

CHUNK = "chunk long, ids binary, sizes binary, bytes binary"


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in pooled(batches, lambda b: b["raw"].map(len), chunk_bytes):
            raw = [bytes(r) for r in rows["raw"]]
            yield pd.DataFrame([{"chunk": new_id(), "ids": pack(rows["row_id"].to_numpy(np.int64)), "sizes": pack(np.array([len(r) for r in raw], np.int64)), "bytes": b"".join(raw)}])
            release_memory()

    return docs.mapInPandas(build, CHUNK)


class Chunk:
    """A chunk's texts and their anchors, these in the order of their hashes and digests; equal ones are one entry."""

    def __init__(self, row, length: int):
        self.ids, sizes = unpack(row["ids"], np.int64), unpack(row["sizes"], np.int64)
        ends, raw = np.cumsum(sizes), bytes(row["bytes"])
        self.texts = [raw[e - s : e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
        self.anchors = [Anchors(t, length) for t in self.texts]
        count = [len(a.hash) for a in self.anchors]
        every = lambda name: np.concatenate([getattr(a, name) for a in self.anchors]) if count else np.zeros(0, np.uint64)
        h, digest = every("hash"), every("digest")
        order = np.lexsort((digest, h))
        self.text_of = np.repeat(np.arange(len(count)), count)[order]
        self.nth = (np.concatenate([np.arange(c) for c in count]) if count else np.zeros(0, np.int64))[order]
        self.starts = (every("last") - every("first") + 1)[order].astype(np.int64)
        h, digest = h[order], digest[order]
        new = runs(h, digest)
        #: Of each entry: its first anchor, hash, digest, and 1 or 2 for one or several anchors; of each anchor: its entry.
        self.head, self.entry = np.flatnonzero(new), np.cumsum(new) - 1
        self.hash, self.digest = h[self.head], digest[self.head]
        self.copies = np.minimum(np.diff(np.append(self.head, len(h))), 2).astype(np.uint8)


def _send(chunks: DataFrame, length: int, bits: int) -> DataFrame:
    """A row for each chunk and range of hashes that it has anchors in."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                c = Chunk(row, length)
                ranges, parts = spans(c.hash, bits)
                yield pd.DataFrame({
                    "range": ranges, "chunk": np.full(len(ranges), row["chunk"]), "hash": [pack_sorted(c.hash[s]) for s in parts],
                    "digest": [pack(c.digest[s]) for s in parts], "copies": [c.copies[s].tobytes() for s in parts],
                })
                del c
                release_memory()

    return chunks.mapInPandas(send, "range int, chunk long, hash binary, digest binary, copies binary")


#: What an entry is: its hash occurs once; a copy of a stretch that another chunk's entry stands for; that other, alone or with copies; one of too many to sort.
ONCE, COPY, SINGLE, SEVERAL, MANY = range(5)


def _classify(group: pd.DataFrame, most: int) -> pd.DataFrame:
    """The kind of each entry; a stretch weighs one entry a chunk, however often it stands there."""
    sizes = [len(b) for b in group["copies"]]
    h, d = np.concatenate([unpack_sorted(b) for b in group["hash"]]), np.concatenate([unpack(b, np.uint64) for b in group["digest"]])
    n = np.concatenate([np.frombuffer(bytes(b), np.uint8) for b in group["copies"]])
    order = np.lexsort((d, h))
    h, d, n = h[order], d[order], n[order]
    new_hash, new = runs(h), runs(h, d)
    of_hash, of_pair = np.cumsum(new_hash) - 1, np.cumsum(new) - 1
    times, copies, distinct = np.bincount(of_hash, weights=n), np.bincount(of_pair, weights=n), np.bincount(of_hash, weights=new)
    kind = np.where(new, np.where(copies[of_pair] > 1, SEVERAL, SINGLE), COPY)
    kind = np.where(times[of_hash] < 2, ONCE, np.where(distinct[of_hash] > most, MANY, kind)).astype(np.uint8)
    release_memory()
    back = np.empty(len(h), np.uint8)
    back[order] = kind
    return group[["range", "chunk", "hash", "digest"]].assign(kind=[x.tobytes() for x in np.split(back, np.cumsum(sizes)[:-1])])


def _answers(right: pd.DataFrame, column: str) -> bytes:
    return b"".join(bytes(b) for b in right.sort_values("range")[column])


def _sort(group: pd.DataFrame, length: int) -> pd.DataFrame:
    """Which strings of some stretches, all those of their anchors, occur again."""
    group = group.sort_values(["hash", "digest"])
    found = repeated_starts([bytes(t) for t in group["stretch"]], group["starts"].tolist(), length)
    found = [np.ones(len(f), bool) if several else f for f, several in zip(found, group["several"], strict=True)]
    release_memory()
    return pd.DataFrame([{
        "range": group["range"].iloc[0], "hash": pack(group["hash"].to_numpy(np.int64)), "digest": pack(group["digest"].to_numpy(np.int64)),
        "starts": pack(np.array([len(f) for f in found], np.int64)), "again": np.packbits(np.concatenate(found)).tobytes(),
    }])


def _reply(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """For each chunk of the range, and each of its entries with a sorted stretch in order, the bits found."""
    if not len(left):
        return pd.DataFrame(columns=["range", "chunk", "again"])
    every = lambda f: np.concatenate([f(row) for _, row in right.iterrows()] or [np.zeros(0, np.uint64)])
    starts = every(lambda r: unpack(r["starts"], np.int64)).astype(np.int64)
    bits = every(lambda r: np.unpackbits(np.frombuffer(bytes(r["again"]), np.uint8), count=int(unpack(r["starts"], np.int64).sum()))).astype(np.uint8)
    own = [np.isin(np.frombuffer(bytes(k), np.uint8), (COPY, SINGLE, SEVERAL)) for k in left["kind"]]
    h = np.concatenate([every(lambda r: unpack(r["hash"], np.uint64)), *(unpack_sorted(b)[o] for b, o in zip(left["hash"], own, strict=True))])
    d = np.concatenate([every(lambda r: unpack(r["digest"], np.uint64)), *(unpack(b, np.uint64)[o] for b, o in zip(left["digest"], own, strict=True))])
    # Entries stand in their order behind the sorted stretch that is theirs.
    at = np.arange(len(h))
    order = np.lexsort((at >= len(starts), d, h))
    stretch = np.empty(len(h), np.int64)
    stretch[order] = order[np.maximum.accumulate(np.where(order < len(starts), at, 0))] if len(h) else order
    stretch = stretch[len(starts) :]
    first, size = np.cumsum(starts) - starts, starts[stretch] if len(starts) else starts
    ends = np.cumsum(size)
    found = bits[np.repeat(first[stretch] - ends + size, size) + np.arange(size.sum())] if len(size) else bits[:0]
    cuts = np.concatenate(([0], ends))[np.cumsum([o.sum() for o in own])[:-1]]
    release_memory()
    return pd.DataFrame({"range": left["range"], "chunk": left["chunk"], "again": [x.tobytes() for x in np.split(found, cuts)]})


def _count_strings(group: pd.DataFrame) -> pd.DataFrame:
    """For strings of anchors with too many stretches: whether the string, by 128 bits, occurs again."""
    sizes = [len(b) for b in group["copies"]]
    a, b = np.concatenate([unpack_sorted(x) for x in group["a"]]), np.concatenate([unpack(x, np.uint64) for x in group["b"]])
    n = np.concatenate([np.frombuffer(bytes(x), np.uint8) for x in group["copies"]])
    order = np.lexsort((b, a))
    of = np.cumsum(runs(a[order], b[order])) - 1
    again = np.zeros(len(a), np.uint8)
    again[order] = np.bincount(of, weights=n[order])[of] > 1
    release_memory()
    return pd.DataFrame({"range": group["range"], "chunk": group["chunk"], "again": [x.tobytes() for x in np.split(again, np.cumsum(sizes)[:-1])]})


def _many(c: Chunk, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """128 bits of the distinct strings of the chunk's anchors with too many stretches, sorted, whether they are one or several there, and which each string is."""
    at = np.flatnonzero(kind[c.entry] == MANY) if len(kind) else []
    found = [c.anchors[t].strings(n) for t, n in zip(c.text_of[at], c.nth[at], strict=True)]
    if not found:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.uint8), np.zeros(0, np.int64))
    a, b = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = runs(a, b)
    of, head = np.empty(len(a), np.int64), np.flatnonzero(new)
    of[order] = np.cumsum(new) - 1
    return a[head], b[head], np.minimum(np.diff(np.append(head, len(a))), 2).astype(np.uint8), of


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, chunk_bytes: int | None = None,
    most: int = MOST_STRETCHES, per_range: int | None = None, per_sort: int = ANCHORS_PER_SORT, keep_bytes: bool = False,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of df, and with keep_bytes the remaining bytes as `kept`.

    A byte is removed where a string of `length` bytes covers it that begins anywhere else too, in the same text or
    another; overlaps count, and all is judged on the texts as given, in UTF-8. A null text is empty; texts of fewer
    bytes stay whole. Repeated rows remove each other's strings. Ids are integers or null. Texts of any length; other
    columns are ignored; an empty table gives no rows. chunk_bytes, most, per_range and per_sort change no result.
    """
    docs = pick(df, id_col, text_col).toDF("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("row_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("raw"))
    chunk_bytes = chunk_bytes or root_sized(CHUNK_BYTES, MOST_CHUNK_BYTES, input_bytes(docs), UNIT_BYTES)
    chunks = stage_by(_chunks(docs, chunk_bytes), "chunk", "chunks")
    anchors = 2 * (chunks.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0) / length
    per_range = per_range or root_sized(ANCHORS_PER_RANGE, MOST_PER_RANGE, anchors, UNIT_ANCHORS)
    bits = max(1, int(np.ceil(np.log2(anchors / per_range + 1))))
    sort_bits = max(bits, int(np.ceil(np.log2(anchors / per_sort + 1))))  # so a sorting task has anchors of one range
    sent = _send(chunks, length, bits).groupBy("range").applyInPandas(lambda g: _classify(g, most), "range int, chunk long, hash binary, digest binary, kind binary")
    sent = stage(sent, "anchors")
    collect_garbage(sent.sparkSession)
    kinds = sent.select("range", "chunk", "kind")

    def stretches(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """A stretch for each entry that stands for its copies."""
        c, kind = Chunk(left.iloc[0], length), np.frombuffer(_answers(right, "kind"), np.uint8)
        at = np.flatnonzero((kind == SINGLE) | (kind == SEVERAL))
        head = c.head[at]
        a = [(c.anchors[t], n) for t, n in zip(c.text_of[head], c.nth[head], strict=True)]
        part = lambda b: (c.hash[at] >> np.uint64(64 - b)).astype(np.int32)
        return pd.DataFrame({
            "range": part(bits), "part": part(sort_bits), "hash": c.hash[at].view(np.int64), "digest": c.digest[at].view(np.int64), "several": kind[at] == SEVERAL,
            "starts": c.starts[head], "stretch": [x.raw[x.first[n] : x.last[n] + length] for x, n in a],
        })

    found = chunks.groupBy("chunk").cogroup(kinds.groupBy("chunk")).applyInPandas(stretches, "range int, part int, hash long, digest long, several boolean, starts long, stretch binary")
    found = found.groupBy("part").applyInPandas(lambda g: _sort(g, length), "range int, hash binary, digest binary, starts binary, again binary")
    again = stage(sent.groupBy("range").cogroup(found.groupBy("range")).applyInPandas(_reply, "range int, chunk long, again binary"), "repeats")
    del found
    collect_garbage(sent.sparkSession)

    def strings(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(left.iloc[0], length)
        a, b, n, _ = _many(c, np.frombuffer(_answers(right, "kind"), np.uint8))
        ranges, parts = spans(a, bits)
        return pd.DataFrame({
            "range": ranges, "chunk": np.full(len(ranges), left["chunk"].iloc[0]),
            "a": [pack_sorted(a[s]) for s in parts], "b": [pack(b[s]) for s in parts], "copies": [n[s].tobytes() for s in parts],
        })

    hot = F.instr(F.hex("kind"), f"0{MANY}") > 0
    with_many = stage(kinds.where(hot).select("chunk").distinct(), "many")
    asked, asking = (x.join(with_many, "chunk", "left_semi") for x in (chunks, kinds))
    single = asked.groupBy("chunk").cogroup(asking.groupBy("chunk")).applyInPandas(strings, "range int, chunk long, a binary, b binary, copies binary")
    single = stage(single.groupBy("range").applyInPandas(_count_strings, "range int, chunk long, again binary"), "strings")
    replies = again.withColumn("which", F.lit("again")).unionByName(kinds.withColumnRenamed("kind", "again").withColumn("which", F.lit("kind")))
    replies = replies.unionByName(single.withColumn("which", F.lit("single")))

    def remove(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(left.iloc[0], length)
        said = {k: _answers(g, "again") for k, g in right.groupby("which")}
        kind = np.frombuffer(said.get("kind", b""), np.uint8)
        repeats = [np.zeros(max(0, len(t) - length + 1), bool) for t in c.texts]

        def mark(at: np.ndarray, of: np.ndarray, bits: np.ndarray) -> None:
            """Set the starts of the anchors `at`, whose bits begin at `of`."""
            for t, n, s, x in zip(c.text_of[at], c.nth[at], c.starts[at], of, strict=True):
                first = int(c.anchors[t].first[n])
                repeats[t][first : first + s] = bits[x : x + s]

        sorted_ = np.isin(kind, (COPY, SINGLE, SEVERAL))
        ends = np.cumsum(np.where(sorted_, c.starts[c.head], 0))
        at = np.flatnonzero(sorted_[c.entry]) if len(kind) else np.zeros(0, np.int64)
        mark(at, (ends - c.starts[c.head])[c.entry[at]], np.frombuffer(said.get("again", b""), np.uint8).astype(bool))
        _, _, _, of = _many(c, kind)
        if len(of):
            at = np.flatnonzero(kind[c.entry] == MANY)
            mark(at, np.cumsum(c.starts[at]) - c.starts[at], np.frombuffer(said["single"], np.uint8).astype(bool)[of])
        release_memory()
        rows = []
        for i, text, begin in zip(c.ids, c.texts, repeats, strict=True):
            kept, removed, spans = text, 0, 0
            if begin.any():
                change = np.zeros(len(text) + 1, np.int64)
                change[: len(begin)] += begin
                change[length : length + len(begin)] -= begin
                gone = np.cumsum(change[:-1]) > 0
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                removed, spans = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            rows.append((i, len(text), removed, spans, hashlib.sha256(kept).hexdigest(), *([kept] if keep_bytes else [])))
        return pd.DataFrame(rows, columns=["row_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_bytes else [])])

    schema = "row_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_bytes else "")
    out = chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(remove, schema)
    return out.withColumn("row_id", F.when(F.col("row_id") != NULL_ID, F.col("row_id")).cast(id_type)).withColumnRenamed("row_id", "doc_id")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).withColumn("has_repeats", F.col("n_removed") > 0)
