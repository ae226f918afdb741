"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Tokenising is one pass over the texts. How to pack depends on the lengths alone, so the plan is made from the
histogram of lengths, which has `capacity` entries at any size of the corpus: documents of over a third of the
capacity are matched greedily in pairs, and smaller ones go best-fit into the gaps. Documents of equal length are
interchangeable; each takes its place in the plan by its rank among those of its length.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from granary.llm.common import new_id, pick, release_memory, stage, table

CAPACITY = 1024
END_ID = 2
#: Pre-tokens kept with their ids by each Python worker; others are encoded anew.
CACHE_SIZE = 300_000
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
#: Texts of these characters only are cut into pre-tokens here, as the tokenizer's own pattern cuts them; others go to it whole.
_SIMPLE = re.compile(f"[\\t\\n\\r -~¡-±´-¸º»¿-ɏ]*")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^ \\t\\n\\r0-9{_LETTERS}]+|[ \\t\\n\\r]+(?![^ \\t\\n\\r])|[ \\t\\n\\r]+")


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_AS_CHARACTERS = _byte_characters()


class PieceEncoder(dict):
    """Ids, as little-endian unsigned 32-bit bytes, of texts under a tokenizer file; keeps those of frequent pre-tokens.

    Where the file is a byte-level BPE that cuts texts as _PIECES does, texts of plain characters are cut here and each
    pre-token is given to the tokenizer's model once; other texts, and all texts under other files, go to it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        kind = json.loads(self.tokenizer.to_str())
        cut = kind["pre_tokenizer"] or {}
        self.cuts = kind["model"]["type"] == "BPE" and kind["normalizer"] is None and (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex")) == ("ByteLevel", False, True)
        # Special tokens are found across pre-tokens.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(_AS_CHARACTERS))]
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) < CACHE_SIZE and len(piece) < 100:
            self[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        if self.cuts and _SIMPLE.fullmatch(text) and not any(s in text for s in self.special):
            return b"".join(map(self.__getitem__, _PIECES.findall(text)))
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One per worker process and file, so that its cache outlives a task."""
    if path not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def tokenised_pieces(df: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, part, nth: the pieces of each document, numbered within (part, length)."""
    docs = pick(df, id_col, text_col).toDF("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part, seen = encoder(tokenizer).encode, new_id(), {}
        for batch in batches:
            for at in range(0, len(batch), 1024):
                some, rows = batch.iloc[at : at + 1024], []
                for doc_id, text in zip(some["doc_id"], some["text"], strict=True):
                    ids = encode(text or "") + end
                    n = len(ids) // 4
                    start, length = 0, (n - 1) % capacity + 1
                    for piece in range(-(-n // capacity)):
                        nth = seen.get(length, 0)
                        seen[length] = nth + 1
                        rows.append((doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), part, nth))
                        start, length = start + length, capacity
                if rows:
                    yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])
            release_memory()

    return docs.mapInPandas(cut, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, part long, nth long")


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Places for counts[length] pieces of each length, and the number of sequences.

    A place is (length, first rank, pieces, first sequence, pieces a sequence, offset): the pieces whose ranks start
    at the first rank fill the sequences in turn from the offset on. Sequences that are filled alike are handled
    together, so the work depends on the number of lengths, not of pieces.
    """
    left = {n: c for n, c in counts.items() if c}
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by what is free: (first sequence, how many)
    rank, places, used = dict.fromkeys(left, 0), [], 0

    def put(length: int, n: int, first: int, each: int, offset: int) -> None:
        places.append((length, rank[length], n, first, each, offset))
        rank[length] += n
        left[length] -= n

    large = sorted(n for n in left if 3 * n > capacity)
    while large:  # the largest with the largest that fits beside it
        a = large[-1]
        b = next((x for x in reversed(large) if a + x <= capacity and (x != a or left[a] > 1)), None)
        pairs = left[a] if b is None else left[a] // 2 if a == b else min(left[a], left[b])
        put(a, pairs, used, 1, 0)
        if b is not None:
            put(b, pairs, used, 1, a)
        gaps[capacity - a - (b or 0)].append((used, pairs))
        used += pairs
        large = [x for x in large if left[x]]
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            free = next((g for g in range(n, capacity + 1) if gaps[g]), None)
            if free is None:
                more = -(-left[n] // (capacity // n))
                gaps[capacity].append((used, more))
                used, free = used + more, capacity
            first, have = gaps[free].pop()
            each = free // n
            full = min(have, left[n] // each)
            if not full:
                each, full = left[n], 1
            put(n, full * each, first, each, capacity - free)
            gaps[free - each * n].append((first, full))
            if have > full:
                gaps[free].append((first + full, have - full))
    return places, used


def pack(df: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of each document.

    A null text is empty; an empty text is its end id alone. Only documents of over `capacity` ids are cut, into
    pieces of `capacity` of which the first may be shorter. Repeated rows are packed each; rows with a null id too.
    Any length of text; other columns are ignored; an empty table gives no rows. Equal lengths rank by partition
    and place in it, as written once.
    """
    pieces = stage(tokenised_pieces(df, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    per_part = stage(pieces.groupBy("part", "length").agg((F.max("nth") + 1).alias("n")), "lengths")
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = per_part.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    counts = dict(map(tuple, per_part.groupBy("length").sum("n").collect()))  # capacity entries at most
    places, _ = plan_packing(counts, capacity)
    by_length: dict[int, list[tuple]] = {}
    for length, *place in places:
        by_length.setdefault(length, []).append(tuple(place))
    starts = {n: [p[0] for p in own] for n, own in by_length.items()}
    ranked = pieces.join(stage(base, "ranks"), ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            found = []
            for length, rank in zip(batch["length"], batch["rank"], strict=True):
                first_rank, _, first, each, offset = by_length[length][bisect.bisect_right(starts[length], rank) - 1]
                at, nth = divmod(rank - first_rank, each)
                found.append((first + at, offset + nth * length))
            out = batch.drop(columns="rank").reset_index(drop=True)
            yield pd.concat([out, pd.DataFrame(found, columns=["sequence_id", "offset"])], axis=1)

    id_type = ranked.schema["doc_id"].dataType.simpleString()
    return ranked.mapInPandas(place, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
