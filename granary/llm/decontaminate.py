"""Benchmark decontamination: rare n-gram seeds join documents with test items, Smith-Waterman alignment decides.

Seeds are a table, and the corpus is read once for any number of test items: documents send the places of n-grams that
may be seeds, these join the seeds by hash, and each pair of a document and an item that share one is aligned where a
bound on its score, from the item's words that stand in the passage at all, leaves that open. An n-gram is rare by the
test items that hold it, not by the documents: copies that recur make no n-gram common, and a document's result does
not depend on what else is in the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from granary.llm.common import discard, lengths, mark, new_id, pick, pooled, release_memory, stage, table
from granary.llm.hashing import joined, word_hashes

SEED_WORDS = 3
#: Share of an item's score with itself that makes a hit, and a score that does for items of any length (50 words in a row).
MIN_SCORE, ENOUGH = 0.5, 100
#: An n-gram of more test items is a seed only where it is the rarest of a stretch of n-grams all of which are in more.
RARE_ITEMS, STRETCH = 20, 4
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bits of the filter of seeds that goes to every task, 2 MB whatever their number; n-grams that pass it wrongly drop out in the join.
FILTER_BITS = 24
#: Texts handled at once by a task.
_CHARS = 1_000_000

#: Letters, digits and every byte of a longer character make words; all else parts them.
_PARTS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-cased words, and where each text's begin and end."""
    h, n = word_hashes([(t or "").lower() for t in texts], _PARTS)
    return h, np.concatenate(([0], np.cumsum(n)))


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    s = h[: max(0, len(h) - k + 1)]
    for j in range(1, k):
        s = joined(s, h[j : j + len(s)])
    return s


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, and the first and one past the last place of it in the passage."""
    n = len(passage)
    ramp = np.arange(n + 1) * GAP
    above, began = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = above[:-1] + np.where(passage == word, MATCH, MISMATCH)
        down = above[1:] + GAP
        row = np.maximum(np.maximum(diagonal, down), 0)
        start = np.where(row == 0, np.arange(1, n + 1), np.where(row == diagonal, began[:-1], began[1:]))
        row, start = np.concatenate(([0], row)), np.concatenate(([0], start))
        reach = np.maximum.accumulate(row - ramp)
        across = reach + ramp
        source = np.maximum.accumulate(np.where(row - ramp == reach, np.arange(n + 1), 0))
        above, began = np.maximum(row, across), np.where(across > row, start[source], start)
        at = int(above.argmax())
        if above[at] > best[0]:
            best = (int(above[at]), int(began[at]), at)
    return best


def score_bound(item: np.ndarray, passage: np.ndarray) -> int:
    """No alignment scores more: each word of the item between its ends matches, which asks for the word, or costs one at least."""
    reach = np.concatenate(([0], np.cumsum(np.where(np.isin(item, passage), MATCH, max(MISMATCH, GAP)))))
    return int((reach - np.minimum.accumulate(reach)).max())


def _read_items(tests: DataFrame) -> DataFrame:
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            h, at = _words(batch["text"].tolist())
            yield pd.DataFrame({"item_key": [new_id() for _ in range(len(batch))], "item_id": batch["item_id"], "n_words": np.diff(at), "item": [h[a:b].tobytes() for a, b in zip(at, at[1:])]})  # noqa: B905

    return tests.mapInPandas(read, "item_key long, item_id string, n_words int, item binary")


def _seeds(items: DataFrame, k: int, rare_items: int) -> DataFrame:
    """gram, item_key, nth: the rare n-grams of each item and their places in it."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, words in zip(batch["item_key"], batch["item"], strict=True):
                g = _grams(np.frombuffer(bytes(words), np.uint64), k)
                yield pd.DataFrame({"gram": g.view(np.int64), "item_key": key, "nth": np.arange(len(g), dtype=np.int32)})

    grams = stage(items.select("item_key", "item").mapInPandas(cut, "gram long, item_key long, nth int"), "grams")
    held = stage(grams.select("gram", "item_key").distinct().groupBy("gram").agg(F.count("*").alias("items")), "held")
    grams = grams.join(held, "gram")
    stretch = W.partitionBy("item_key").orderBy("nth").rowsBetween(0, STRETCH - 1)
    rarest = grams.withColumn("rarest", F.min(F.struct("items", "gram", "item_key", "nth")).over(stretch)).where(F.col("rarest.items") > rare_items)
    rarest = rarest.select("rarest.gram", "rarest.item_key", "rarest.nth").distinct()
    return grams.where(F.col("items") <= rare_items).select("gram", "item_key", "nth").unionByName(rarest)


def _filter(seeds: DataFrame) -> np.ndarray:
    """One bit for each value of the first FILTER_BITS bits of a hash; of fixed size, put together by the executors."""
    first = f"shiftrightunsigned(gram, {64 - FILTER_BITS})"
    parts = seeds.selectExpr(f"cast(shiftright({first}, 5) as int) as at", f"shiftleft(1L, cast({first} & 31 as int)) as bit")
    bits = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    for at, word in parts.groupBy("at").agg(F.bit_or("bit")).toLocalIterator():
        bits[at] = word
    return bits


def _find(docs: DataFrame, bits: np.ndarray, k: int, reach: int) -> DataFrame:
    """For each document with an n-gram that passes the filter: these and their places, and the words up to `reach` around them."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rows in pooled(iter([batch]), lambda b: lengths(b["text"]), _CHARS):
                h, at = _words(rows["text"].tolist())
                g = _grams(h, k)
                first = g >> np.uint64(64 - FILTER_BITS)
                where = np.flatnonzero(bits[(first >> np.uint64(5)).astype(np.int64)] >> (first & np.uint64(31)).astype(np.uint32) & np.uint32(1))
                text = np.searchsorted(at, where, side="right") - 1
                inside = where + k <= at[text + 1]
                where, text = where[inside], text[inside]
                cuts, out = [*np.flatnonzero(np.diff(text, prepend=-1)).tolist(), len(where)], []
                for a, b in zip(cuts, cuts[1:]):  # noqa: B905
                    d, places = int(text[a]), where[a:b]
                    begin, end = max(int(at[d]), int(places[0]) - reach), min(int(at[d + 1]), int(places[-1]) + reach)
                    out.append((new_id(), rows["doc_id"].iloc[d], begin - int(at[d]), h[begin:end].tobytes(), g[places].view(np.int64).tolist(), (places - at[d]).tolist()))
                if out:
                    yield pd.DataFrame(out, columns=["row_id", "doc_id", "offset", "words", "grams", "places"])
            release_memory()

    return docs.mapInPandas(find, "row_id long, doc_id string, offset int, words binary, grams array<long>, places array<int>")


def align(item: np.ndarray, passage: np.ndarray, diagonals: list[int], need: int) -> tuple[int, int, int]:
    """The best alignment of the item near one of the diagonals (place in the passage minus place in the item) that scores `need` or more, else zeros."""
    pad, spans, best = max(0, MATCH * len(item) - need) // -GAP + 1, [], (0, 0, 0)  # more gaps leave too low a score
    for s in sorted(diagonals):  # passages that overlap are aligned as one
        a, b = max(0, s - pad), min(len(passage), s + len(item) + pad)
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    for a, b in spans:
        if score_bound(item, passage[a:b]) >= need:
            score, x, y = smith_waterman(item, passage[a:b])
            best = max(best, (score, x + a, y + a), key=lambda z: z[0])
    return best if best[0] >= need else (0, 0, 0)


def needed(n_words: int, min_score: float = MIN_SCORE) -> int:
    """The least score that makes a hit of an item of so many words."""
    return min(int(np.ceil(min_score * MATCH * n_words)), ENOUGH)


def contaminated(docs: DataFrame, benchmark: DataFrame, seed_words: int = SEED_WORDS, min_score: float = MIN_SCORE, rare_items: int = RARE_ITEMS) -> DataFrame:
    """doc_id, item_id, score, start_word, end_word, n_seeds: for each document and test item with an alignment that reaches
    min_score of the item's with itself, or ENOUGH, near a seed that both hold. start_word and end_word bound the best one's
    passage among the document's words, n_seeds counts the places of seeds that they share.

    Seeds are runs of seed_words words of an item that at most rare_items items hold, and where a whole stretch of runs is
    in more, its rarest. Words are runs of letters and digits, lower-cased. Null, empty and blank texts, and items of fewer
    words than a seed has, match nothing. Of equally good passages the first counts. Repeated documents and repeated items
    give a row each, null ids too. Texts of any length; other columns are ignored; empty tables give no rows.
    """
    docs, tests = pick(docs, "doc_id", "text"), pick(benchmark, "item_id", "text")
    kinds = [docs.schema["doc_id"].dataType.simpleString(), tests.schema["item_id"].dataType.simpleString()]
    # Ids of any type go through Python as text, where null integers would turn into floats.
    docs, tests = docs.withColumn("doc_id", F.col("doc_id").cast("string")), tests.withColumn("item_id", F.col("item_id").cast("string"))
    since = mark()
    items = stage(_read_items(tests), "items")
    seeds = stage(_seeds(items, seed_words, rare_items), "seeds")
    longest = items.agg(F.max("n_words")).first()[0] or 0
    found = stage(_find(docs, _filter(seeds), seed_words, 3 * longest + 2), "found")  # an item and its gaps on either side
    hits = found.select("row_id", F.explode(F.arrays_zip("grams", "places")).alias("_h")).select("row_id", F.col("_h.grams").alias("gram"), F.col("_h.places").alias("place"))
    pairs = hits.join(seeds, "gram").groupBy("row_id", "item_key").agg(F.collect_set(F.col("place") - F.col("nth")).alias("diagonals"), F.count("*").cast("int").alias("n_seeds"))
    pairs = stage(pairs, "pairs")
    discard(pairs.sparkSession, since, items, found, pairs)
    pairs = pairs.join(found.select("row_id", "doc_id", "offset", "words"), "row_id")
    # The words that the pair's alignments may cover, not the document's.
    reach = 3 * F.col("n_words") + 2
    begin = F.greatest(F.lit(0), F.array_min("diagonals") - reach - F.col("offset"))
    length = F.array_max("diagonals") + reach - F.col("offset") - F.col("begin")
    pairs = pairs.join(items, "item_key").withColumn("begin", begin)
    pairs = pairs.select("doc_id", "item_id", "item", "diagonals", "n_seeds", (F.col("begin") + F.col("offset")).alias("begin"), F.substring("words", F.col("begin") * 8 + 1, length * 8).alias("words"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                item, passage = (np.frombuffer(bytes(b), np.uint64) for b in (r.item, r.words))
                best, x, y = align(item, passage, [d - r.begin for d in r.diagonals], needed(len(item), min_score))
                if best:
                    out.append((r.doc_id, r.item_id, best / (MATCH * len(item)), x + r.begin, y + r.begin, r.n_seeds))
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "score", "start_word", "end_word", "n_seeds"])

    out = pairs.mapInPandas(score, "doc_id string, item_id string, score double, start_word long, end_word long, n_seeds int")
    return out.withColumns({"doc_id": F.col("doc_id").cast(kinds[0]), "item_id": F.col("item_id").cast(kinds[1])})


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
