"""N-gram Jaccard join by prefix filters under several global token orders.

Two sets that overlap enough must share a token among the first few of each, under every global order of tokens. The
first order is by rarity in the corpus: documents whose rarest tokens are theirs alone drop out, and the others fall
into small groups that share rare tokens. Groups are compared by blocks; a pair is verified only where the prefixes
meet under all orders. Pairs are never listed: a block gives back a spanning forest of its links, and their number for
each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import UNIT_BYTES, collect_garbage, discard, input_bytes, lengths, mark, new_id, pick, pooled, release_memory, root_sized, stage, stage_by, table
from granary.llm.components import components
from granary.llm.hashing import joined, mix, pack, pack_sorted, spans, unpack, unpack_sorted, word_hashes

#: Characters of a chunk, and shingles that one counting task handles, about: the least and the most.
CHUNK_BYTES, MOST_CHUNK_BYTES = 4 << 20, 10 << 20
KEYS_PER_RANGE, MOST_PER_RANGE = 500_000, 4_000_000
#: Words in a table of UNIT_BYTES, about.
UNIT_WORDS = 28_000_000
#: Documents of a block; a group of more is dealt over pairs of blocks.
BLOCK = 256
#: Small groups are compared together, about so many documents a task.
BUNDLE = 512
#: Further orders: by a hash under each of these seeds.
SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344)
NULL_ID = -(1 << 63)
_COLUMNS = 2048

CHUNK = "chunk long, n_tokens long, ids binary, sizes binary, words binary, codes binary"


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of k words in a row; of all words where there are fewer; none without words."""
    if not len(words):
        return words
    n = max(1, len(words) - k + 1)
    s = words[:n]
    for j in range(1, min(k, len(words))):
        s = joined(s, words[j : j + n])
    return np.unique(s if len(words) >= k else s ^ np.uint64(len(words)))


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in pooled(batches, lambda b: lengths(b["text"]), chunk_bytes):
            h, n = word_hashes(rows["text"].tolist())
            words, codes = np.unique(h, return_inverse=True)
            yield pd.DataFrame([{
                "chunk": new_id(), "n_tokens": len(h), "ids": pack(rows["row_id"].to_numpy(np.int64)), "sizes": pack(n.astype(np.int64)),
                "words": pack(words), "codes": pack(codes.astype(np.uint32)),
            }])
            release_memory()

    return docs.mapInPandas(build, CHUNK)


def _sets(row, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    tokens = unpack(row["words"], np.uint64)[unpack(row["codes"], np.uint32)]
    return unpack(row["ids"], np.int64), [shingle_set(w, k) for w in np.split(tokens, np.cumsum(unpack(row["sizes"], np.int64))[:-1])]


def _send(chunks: DataFrame, k: int, bits: int) -> DataFrame:
    """Each chunk's distinct shingles and in how many of its documents they are, a row for each range of hashes that has some."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                keys, n = np.unique(np.concatenate(_sets(row, k)[1]), return_counts=True)
                ranges, parts = spans(keys, bits)
                yield pd.DataFrame({"range": ranges, "chunk": np.full(len(ranges), row["chunk"]), "keys": [pack_sorted(keys[s]) for s in parts], "n": [pack(n[s].astype(np.uint32)) for s in parts]})
                release_memory()

    return chunks.mapInPandas(send, "range int, chunk long, keys binary, n binary")


def _count(group: pd.DataFrame) -> pd.DataFrame:
    keys = [unpack_sorted(b) for b in group["keys"]]
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(at, weights=np.concatenate([unpack(b, np.uint32) for b in group["n"]]), minlength=len(found)).astype(np.uint32)
    release_memory()
    return pd.DataFrame({"range": group["range"], "chunk": group["chunk"], "df": [pack(x) for x in np.split(n[at], np.cumsum([len(x) for x in keys])[:-1])]})


def prefix_size(n: int, percent: int) -> int:
    """How many first tokens of a set of n must hold one of any set that links with it."""
    return n - -(-percent * n // 100) + 1


def _forest(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Spanning links (a, b, 0) and per document (a, a, links to others) of one group or pair of blocks."""
    out = []
    for _, docs in group.groupby("component"):
        docs = docs.drop_duplicates("row_id").sort_values("row_id")
        ids, n, weight, side = (docs[c].to_numpy() for c in ("row_id", "n", "copies", "block"))
        if len(ids) < 2:
            continue
        tokens = [unpack(t, np.uint64) for t in docs["tokens"]]
        room = docs["prefix"].to_numpy()
        may = np.ones((len(ids), len(ids)), bool)
        for seed in (None, *SEEDS):
            order = [t[:r] if seed is None else t[np.argsort(mix(t ^ np.uint64(seed)), kind="stable")[:r]] for t, r in zip(tokens, room, strict=True)]
            may &= _overlap(order) > 0
        np.fill_diagonal(may, False)
        lo, hi = group["bi"].iloc[0], group["bj"].iloc[0]
        if lo != hi:  # pairs inside a block are the business of the task of that block with itself
            may &= side[:, None] != side[None, :]
        some = may.any(axis=1)
        if not some.any():
            continue
        at = np.flatnonzero(some)
        shared = _overlap([tokens[i] for i in at])
        link = may[np.ix_(at, at)] & (100 * shared >= percent * (n[at][:, None] + n[at][None, :] - shared))
        degree = link @ weight[at]
        out += [(int(ids[i]), int(ids[i]), int(d)) for i, d in zip(at, degree, strict=True) if d]
        parent = list(range(len(at)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x, y in zip(*np.nonzero(np.triu(link)), strict=True):
            if (p := find(x)) != (q := find(y)):
                parent[max(p, q)] = min(p, q)
                out.append((int(ids[at[x]]), int(ids[at[y]]), 0))
    return pd.DataFrame(out, columns=["a", "b", "links"]).astype("int64")


def _overlap(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two sets share, as products of 0/1 matrices of a bounded number of columns."""
    every, at = np.unique(np.concatenate(sets), return_inverse=True)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(at, kind="stable")
    at, rows = at[order], rows[order]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for start in range(0, len(every), _COLUMNS):
        a, b = np.searchsorted(at, [start, start + _COLUMNS])
        m = np.zeros((len(sets), _COLUMNS), np.float32)
        m[rows[a:b], at[a:b] - start] = 1
        out += (m @ m.T).astype(np.int64)
    return out


def _placed(grouped: DataFrame, percent: int, block: int) -> DataFrame:
    """Where each document (row_id, component, n) is compared: bundle, and the blocks bi and bj that meet there.

    Small groups are blocks of their own. A large one is cut into levels of set size, such that sets which link are of
    one level or of neighbours (a smaller set has `percent` of the larger's tokens at least), and these into blocks;
    blocks meet within a level and with those of the next.
    """
    width = -np.log(percent / 100) * (1 + 1e-9)
    level = F.floor(F.log("n") / F.lit(float(width))).cast("int") if percent < 100 else F.col("n").cast("int")
    sizes = stage(grouped.groupBy("component").agg(F.count("*").alias("m")), "group_sizes")
    rows = grouped.join(sizes, "component").withColumn("split", F.col("m") > block)
    rows = stage(rows.select("row_id", "component", "split", F.when(F.col("split"), level).otherwise(0).alias("level")), "levels")
    counts = stage(rows.groupBy("component", "level").agg(F.ceil(F.count("*") / block).cast("int").alias("nb")), "level_sizes")
    near = counts.select("component", F.col("level").alias("other"), F.col("nb").alias("other_nb"), F.explode(F.sequence(F.col("level") - 1, F.col("level") + 1)).alias("level"))
    near = stage(counts.join(near, ["component", "level"]), "level_pairs")  # a row for each level and neighbour of a group
    bundles = max(1, -(-rows.count() // BUNDLE))
    number = lambda level, i: F.shiftleft(level.cast("long"), 32) + i
    placed = rows.join(near, ["component", "level"]).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("other_nb") - 1)))
    own, other = number(F.col("level"), F.pmod(F.xxhash64("row_id"), "nb").cast("int")), number(F.col("other"), F.col("with"))
    bundle = F.when(F.col("split"), F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(bundles)))
    placed = placed.select("row_id", "component", "split", bundle.alias("bundle"), own.alias("block"), F.least(own, other).alias("bi"), F.greatest(own, other).alias("bj"))
    return stage(placed, "placed")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 85, chunk_bytes: int | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for each row of df; ids are integers.

    A document's set holds its distinct shingles of `words` words, A-Z lower-cased; with fewer words the whole sequence
    is its one shingle; without words, or with a null text, the set is empty and linked with nothing. Two documents link
    when 100 * intersection >= percent * union. component_id is the least id that links reach; n_links counts the other
    documents that the row's own set links with directly, an id with several sets once for each. Rows that repeat an id are one
    node of the graph, with the links of all their sets; null ids are one node below all others, shown as null. Any length of text; other columns are ignored; an empty table gives no rows.
    """
    docs = pick(df, id_col, text_col).toDF("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("row_id"), "text")
    chunk_bytes = chunk_bytes or root_sized(CHUNK_BYTES, MOST_CHUNK_BYTES, input_bytes(docs), UNIT_BYTES)
    since = mark()
    chunks = stage_by(_chunks(docs, chunk_bytes), "chunk", "chunks")
    total = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    per_range = root_sized(KEYS_PER_RANGE, MOST_PER_RANGE, total, UNIT_WORDS)
    bits = max(1, int(np.ceil(np.log2(total / per_range + 1))))
    answers = stage(_send(chunks, words, bits).groupBy("range").applyInPandas(_count, "range int, chunk long, df binary"), "frequencies")
    collect_garbage(answers.sparkSession)

    def order(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Per document: size, digest, and where its rarest tokens are not its own alone, the shared tokens by rarity."""
        ids, sets = _sets(left.iloc[0], words)
        flat = np.concatenate(sets)
        keys, at = np.unique(flat, return_inverse=True)
        df = np.concatenate([unpack(b, np.uint32) for b in right.sort_values("range")["df"]] or [np.zeros(0, np.uint32)])[at]
        rows, start = [], 0
        for i, s in zip(ids, sets, strict=True):
            n, own = len(s), df[start : start + len(s)]
            start += n
            mixed = mix(s ^ np.uint64(0x5851F42D4C957F2D))
            a, b = (int(v.astype(np.int64)) for v in (mixed.sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed) if n else np.uint64(0)))
            shared = own >= 2
            room = prefix_size(n, percent) - (n - int(shared.sum()))
            if n and room > 0:
                t = s[shared][np.lexsort((s[shared], own[shared]))]
                rows.append((i, n, a, b, room, t[:room].astype(np.int64).tolist(), pack(t)))
            else:
                rows.append((i, n, a, b, 0, None, None))
        del flat, keys, at, df, sets
        release_memory()
        return pd.DataFrame(rows, columns=["row_id", "n", "d1", "d2", "prefix", "rare", "tokens"])

    found = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(order, "row_id long, n long, d1 long, d2 long, prefix int, rare array<long>, tokens binary")
    found = stage(found, "sets")
    discard(found.sparkSession, since, found)
    # Equal sets, told by their size and 128 bits, are one class, numbered as it is written; empty sets stand alone.
    digest = ["n", "d1", "d2"]
    classes = found.where("n > 0").groupBy(*digest).agg(F.min("row_id").alias("rep"), F.count_distinct("row_id").alias("copies"))
    classes = stage(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    members = found.where("n > 0").select("row_id", *digest).join(classes, digest).select("row_id", "class")
    reps = found.where("prefix > 0").join(classes, digest).where("row_id = rep").withColumn("row_id", F.col("class"))
    tokens = stage(reps.select("row_id", F.explode("rare").alias("token")).distinct(), "rare")
    leaders = stage(tokens.groupBy("token").agg(F.min("row_id").alias("leader"), F.count("*").alias("m")).where("m > 1").drop("m"), "leaders")
    grouped = stage(components(tokens.join(leaders, "token").select(F.col("row_id").alias("a"), F.col("leader").alias("b"))), "groups")
    placed = _placed(grouped.select(F.col("node").alias("row_id"), "component").join(reps.select("row_id", "n"), "row_id"), percent, block)
    work = reps.select("row_id", "n", "prefix", "tokens", "copies").join(placed, "row_id")
    forest = stage(work.groupBy("split", "bundle", "bi", "bj").applyInPandas(lambda g: _forest(g, percent), "a long, b long, links long"), "forest")
    # The classes of an id that has several are linked by it.
    several = stage(members.groupBy("row_id").agg(F.min("class").alias("first"), F.max("class").alias("last")).where("first < last").drop("last"), "several")
    by_id = members.join(several, "row_id").where("class != first").select(F.col("class").alias("a"), F.col("first").alias("b")).distinct()
    linked = stage(components(forest.where("a != b").select("a", "b").unionByName(by_id)).withColumnRenamed("node", "class"), "reached")
    least = stage(linked.join(classes.select("class", "rep"), "class").groupBy("component").agg(F.min("rep").alias("least")), "least")
    degrees = forest.where("links > 0").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    classes = classes.join(linked.join(least, "component").select("class", "least"), "class", "left").join(degrees, "class", "left")
    classes = stage(classes.withColumn("component", F.coalesce("least", "rep")).select("class", *digest, "component", "links", "copies"), "linked")
    # Rows without words belong to the other rows of their id.
    empty = members.join(found.where("n = 0").select("row_id").distinct(), "row_id", "left_semi").groupBy("row_id").agg(F.min("class").alias("class"))
    empty = stage(empty.join(classes.select("class", "component"), "class").select("row_id", F.lit(0).cast("long").alias("n"), F.col("component").alias("of_id")), "empty")
    discard(found.sparkSession, since, found, classes, empty)
    out = found.select("row_id", *digest).join(classes, digest, "left").join(empty, ["row_id", "n"], "left")
    as_id = lambda c: F.when(c != NULL_ID, c).cast(id_type)
    return out.select(
        as_id(F.col("row_id")).alias("doc_id"), F.col("n").alias("n_shingles"), as_id(F.coalesce("component", "of_id", "row_id")).alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
