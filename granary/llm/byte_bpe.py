"""Byte-level BPE over whole corpora: every distinct word is encoded once.

Texts are cut into pre-tokens ("words") in numpy, a few MB at a time, and written as chunks: the distinct words of the
chunk, and for every position the number of its word. Each chunk sends its distinct words by hash range; a range's task
encodes each distinct word of the corpus once and answers every chunk in the order of its words. The chunk, which has
stayed where it is, then puts the ids of its words in their positions. So what is shuffled is one entry for each
distinct word of a chunk, and a frequent word weighs as much as a rare one.

Decoding joins ids with the table of the vocabulary's bytes, which is as small as the vocabulary.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import UNIT_BYTES, input_bytes, lengths, new_id, pick, pooled, release_memory, root_sized, stage, stage_by, table
from granary.llm.hashing import joined, mix, pack, unpack

#: Characters of a chunk, and distinct words of chunks that one range has, about: the least and the most.
CHUNK_CHARS, MOST_CHUNK_CHARS = 4 << 20, 10 << 20
WORDS_PER_RANGE, MOST_PER_RANGE = 300_000, 3_000_000
OTHER, LETTER, DIGIT, SPACE, EDGE = range(5)
#: Stands between texts; no character has this number.
_EDGE = 0x110000
_SUFFIXES = [b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"]


@functools.cache
def _kinds() -> np.ndarray:
    """The kind of each character, by number."""
    out = np.zeros(_EDGE + 1, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, _EDGE)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[[ord(c) for c in m[0]]] = kind
    out[_EDGE] = EDGE
    return out


def cuts(characters: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin among characters (by number, texts parted by _EDGE, one at the end), as
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ cuts them.

    Each _EDGE begins one of its own.
    """
    kind = _kinds()[characters]
    begins = np.concatenate(([True], kind[1:] != kind[:-1]))
    begins |= kind == EDGE
    # The last of the white space before anything but an edge stands for itself, and a blank joins what follows.
    after = 1 + np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != EDGE))
    begins[after - 1] = True
    begins[after[characters[after - 1] == ord(" ")]] = False
    # Suffixes, where an apostrophe is the first of a match.
    at = np.flatnonzero((characters[:-1] == ord("'")) & begins[:-1])
    for suffix in _SUFFIXES:
        own = at[at + len(suffix) < len(characters)]
        for i, c in enumerate(suffix):
            own = own[characters[own + 1 + i] == c]
        begins[own + 1] = False
        begins[own + 1 + len(suffix)] = True
    return np.flatnonzero(begins)


def _hashes(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the slices of buffer, which ends in 8 bytes that belong to none."""
    lanes = np.lib.stride_tricks.as_strided(buffer, (len(buffer) - 7, 8), (1, 1))
    masks = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
    h, rest, at = mix(sizes.astype(np.uint64) + np.uint64(seed << 48)), np.arange(len(starts)), 0
    while len(rest):
        left = sizes[rest] - at
        lane = np.ascontiguousarray(lanes[starts[rest] + at]).view("<u8").ravel() & masks[np.minimum(left, 8)]
        h[rest] = joined(h[rest], lane)
        rest, at = rest[left > 8], at + 8
    return h


def _same(buffer: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> bool:
    """Whether the slices at a and b, of these sizes, are equal throughout."""
    lanes = np.lib.stride_tricks.as_strided(buffer, (len(buffer) - 7, 8), (1, 1))
    masks = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
    rest, at = np.flatnonzero(a != b), 0
    while len(rest):
        left = sizes[rest] - at
        differ = np.ascontiguousarray(lanes[a[rest] + at]).view("<u8").ravel() ^ np.ascontiguousarray(lanes[b[rest] + at]).view("<u8").ravel()
        if (differ & masks[np.minimum(left, 8)]).any():
            return False
        rest, at = rest[left > 8], at + 8
    return True


def words_of(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct pre-tokens of texts, frequent ones first; the place of every pre-token's in these; and how many each text has."""
    edge = [_EDGE]
    characters = np.concatenate([x for t in texts for x in (np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), "<u4"), edge)])
    starts = cuts(characters)
    is_edge = characters[starts] == _EDGE
    n = np.diff(np.flatnonzero(is_edge), prepend=-1) - 1
    width = 1 + (characters >= 0x80).astype(np.int8) + (characters >= 0x800) + (characters >= 0x10000)
    width[characters == _EDGE] = 1  # a line feed in the bytes
    at = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))
    buffer = np.frombuffer(b"".join(x for t in texts for x in ((t or "").encode("utf-8", "surrogatepass"), b"\n")) + bytes(8), np.uint8)
    begins = at[starts]
    sizes = np.diff(begins, append=at[-1])[~is_edge]
    begins = begins[~is_edge]
    del characters, width, at
    for seed in itertools.count():  # another one, should two words have one hash
        found, first, codes = np.unique(_hashes(buffer, begins, sizes, seed), return_index=True, return_inverse=True)
        if (sizes[first][codes] == sizes).all() and _same(buffer, begins[first][codes], begins, sizes):
            break
    order = np.argsort(-np.bincount(codes, minlength=len(found)), kind="stable")
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order))
    raw, first = buffer.tobytes(), first[order]
    words = [raw[s : s + k] for s, k in zip(begins[first].tolist(), sizes[first].tolist(), strict=True)]
    return words, place[codes], n


def ranges_of(words: list[bytes], bits: int) -> np.ndarray:
    """Which of 2**bits ranges of hashes each word is in."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    buffer = np.frombuffer(b"".join(words) + bytes(8), np.uint8)
    return (_hashes(buffer, np.cumsum(sizes) - sizes, sizes) >> np.uint64(64 - bits)).astype(np.int32)


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a .tiktoken file: the bytes of each token and its id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.cache
def _encoding(path: str):
    """Encodes a whole text as one word; of public_tokenizers.PATTERN it knows nothing. One in each worker."""
    import tiktoken

    return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=read_ranks(path), special_tokens={})


@functools.cache
def _vocabulary(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens one after the other; where each id's begin; how many it has (-1: no such id)."""
    ranks = read_ranks(path)
    size = np.full(max(ranks.values(), default=-1) + 2, -1, np.int64)
    for token, rank in ranks.items():
        size[rank] = len(token)
    start = np.concatenate(([0], np.cumsum(np.maximum(size, 0))[:-1]))
    return np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8), start, size


def decode_ids(ids: np.ndarray, path: str) -> bytes:
    """The bytes of the tokens in their order; an id that the vocabulary doesn't have raises KeyError."""
    flat, start, size = _vocabulary(path)
    known = size[np.minimum(ids, len(size) - 1)] if len(ids) else np.zeros(0, np.int64)
    if (known < 0).any() or (ids < 0).any():
        raise KeyError(f"no token {int(ids[(known < 0) | (ids < 0)][0])}")
    ends = np.cumsum(known)
    if not len(ids):
        return b""
    return flat[np.arange(ends[-1]) + np.repeat(start[ids] - (ends - known), known)].tobytes()


CHUNK = "chunk long, n_words long, ids binary, sizes binary, codes binary, words binary"


def _bytes_of(words: list[bytes]) -> bytes:
    """Words as bytes: how many, how long each is, and one after the other; _words_of reverses it."""
    return len(words).to_bytes(8, "little") + pack(np.fromiter(map(len, words), np.uint32, len(words))) + b"".join(words)


def _words_of(raw: bytes) -> list[bytes]:
    n = int.from_bytes(raw[:8], "little")
    ends = (8 + 4 * n + np.cumsum(unpack(raw[8 : 8 + 4 * n], np.uint32), dtype=np.int64)).tolist()
    return [raw[a:b] for a, b in zip([8 + 4 * n, *ends], ends, strict=False)]


def _chunks(docs: DataFrame, chars: int) -> DataFrame:
    """Texts as rows of many: row numbers, pre-tokens of each text, their codes, and the distinct words that these stand for."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in pooled(batches, lambda b: lengths(b["text"]) + 1, chars):
            words, codes, n = words_of(rows["text"].tolist())
            out = {"chunk": new_id(), "n_words": len(words), "ids": pack(rows["row_id"].to_numpy(np.int64)), "sizes": pack(n.astype(np.int64)), "codes": pack(codes), "words": _bytes_of(words)}
            del words, codes
            yield pd.DataFrame([out])
            release_memory()

    return docs.mapInPandas(build, CHUNK)


def _send(chunks: DataFrame, bits: int) -> DataFrame:
    """Each chunk's distinct words, a row for each of 2**bits ranges of their hashes that has some."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                words, found = _words_of(row.words), {}
                for word, own in zip(words, ranges_of(words, bits).tolist(), strict=True):
                    found.setdefault(own, []).append(word)
                if found:
                    yield pd.DataFrame({"range": list(found), "chunk": row.chunk, "words": [_bytes_of(x) for x in found.values()]})
                release_memory()

    return chunks.select("chunk", "words").mapInPandas(send, "range int, chunk long, words binary")


def _encode_range(group: pd.DataFrame, path: str) -> pd.DataFrame:
    """The ids of one range's words, for each chunk in the order of its words: how many each has, and all of them."""
    encode, known, sizes, ids = _encoding(path).encode_ordinary, {}, [], []
    for raw in group["words"]:
        own = []
        for word in _words_of(raw):
            found = known.get(word)
            if found is None:
                # A word that is cut from a text is a text itself.
                found = known[word] = np.array(encode(word.decode("utf-8", "surrogatepass")), np.uint32)
            own.append(found)
        sizes.append(pack(np.fromiter(map(len, own), np.uint32, len(own))))
        ids.append(pack(np.concatenate(own)))
    release_memory()
    return pd.DataFrame({"range": group["range"], "chunk": group["chunk"], "n_ids": sizes, "word_ids": ids})


def _place(left: pd.DataFrame, right: pd.DataFrame, bits: int) -> pd.DataFrame:
    """The ids of each text of a chunk: those of its words, in their positions."""
    if not len(left):
        return pd.DataFrame({"row_id": np.zeros(0, np.int64), "ids": []})
    row = left.iloc[0]
    answers = right.sort_values("range")
    gather = lambda c: np.concatenate([unpack(x, np.uint32) for x in answers[c]] or [np.zeros(0, np.uint32)])
    size, ids = gather("n_ids").astype(np.int64), gather("word_ids")
    start = np.cumsum(size) - size
    # Answers are by range, and in a range in the order of the chunk's words.
    place = np.empty(len(size), np.uint32)
    place[np.argsort(ranges_of(_words_of(row["words"]), bits), kind="stable")] = np.arange(len(size))
    at = place[unpack(row["codes"], np.uint32)]
    n = size[at]
    ends = np.cumsum(n)
    flat = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[at] - (ends - n), n)].astype(np.int32)
    texts = np.cumsum(unpack(row["sizes"], np.int64))
    bounds = np.concatenate(([0], ends))[texts]
    out = pd.DataFrame({"row_id": unpack(row["ids"], np.int64), "ids": np.split(flat, bounds[:-1])})
    release_memory()
    return out


def encode(df: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int | None = None) -> DataFrame:
    """doc_id, ids (array of int) for each row of df, by the vocabulary in the file `ranks`.

    A null text is empty and has no ids. Rows with a null id and repeated rows are encoded each. Texts of any length
    that a task holds; words of any length. Special tokens are ordinary text. Other columns are ignored; an empty table
    gives no rows.
    """
    docs = pick(df, id_col, text_col).toDF("doc_id", "text")
    plain = dict(docs.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint")
    null_id = -(1 << 63)
    if plain:
        keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(null_id)).alias("row_id"), "text")
    else:  # rows go by their place in the written table
        docs = stage(docs.withColumn("row_id", F.monotonically_increasing_id()), "rows")
        keyed = docs.select("row_id", "text")
    size = input_bytes(keyed)
    chunks = stage_by(_chunks(keyed, chunk_chars or root_sized(CHUNK_CHARS, MOST_CHUNK_CHARS, size, UNIT_BYTES)), "chunk", "chunks")
    per_range = root_sized(WORDS_PER_RANGE, MOST_PER_RANGE, size, UNIT_BYTES)
    total = chunks.agg(F.sum("n_words")).first()[0] or 0
    bits = max(1, int(np.ceil(np.log2(total / per_range + 1))))
    answers = _send(chunks, bits).groupBy("range").applyInPandas(lambda g: _encode_range(g, ranks), "range int, chunk long, n_ids binary, word_ids binary")
    asked = chunks.drop("n_words").groupBy("chunk")
    out = asked.cogroup(answers.groupBy("chunk")).applyInPandas(lambda a, b: _place(a, b, bits), "row_id long, ids array<int>")
    if plain:
        return out.select(F.when(F.col("row_id") != null_id, F.col("row_id")).cast(dict(docs.dtypes)["doc_id"]).alias("doc_id"), "ids")
    return stage(out, "ids").join(docs.select("row_id", "doc_id"), "row_id").select("doc_id", "ids")


def _id_lists(ids: pa.ListArray) -> Iterator[np.ndarray]:
    flat, bounds = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy().tolist()
    return (flat[a:b] for a, b in zip(bounds, bounds[1:], strict=False))


def decode(df: DataFrame, ranks: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """df with the bytes of its ids as a further column, by the vocabulary in the file `ranks`; null ids decode to null.

    An id that the vocabulary doesn't have fails the task with KeyError. Other columns stay as they are.
    """
    at = df.columns.index(ids_col)
    kinds = [f.dataType.simpleString() for f in df.schema]
    # Columns may have any names meanwhile.
    own = df.toDF(*(f"_c{i}" for i in range(len(kinds))))
    schema = ", ".join(f"_c{i} {k}" for i, k in enumerate(kinds)) + ", decoded binary"

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(at)
            found = [decode_ids(x, ranks) if there else None for x, there in zip(_id_lists(ids), ids.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, "decoded"])

    return own.mapInArrow(look_up, schema).toDF(*df.columns, to)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = encode(table(spark, sf_dir, "documents"), ranks)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [(len(x), hashlib.sha256(x.astype("<u4")).hexdigest(), hashlib.sha256(decode_ids(x, ranks)).hexdigest()) for x in _id_lists(batch.column("ids"))]
            n, ids, decoded = zip(*every, strict=True) if every else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            release_memory()

    return encoded.mapInArrow(digest, f"doc_id {dict(encoded.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
