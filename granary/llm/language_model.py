"""Trigram scoring with deleted interpolation.

The probability of a token mixes its maximum-likelihood estimates after the two tokens and the one token before it, its
unigram estimate and an add-one floor. The mixture weights depend on how frequent the context is (the two tokens before,
where these were counted, else the one), and are learned by expectation-maximisation on documents held out of the counts.

Texts are hashed once into written chunks of a few MB. Each chunk sends its distinct unigrams and bigrams, by hash,
to the task that counts that range of hashes, and gets the corpus counts back in the same order; then, in the same way,
its trigrams. Two tokens that were counted once, and that no document held out of all counts has, are followed by one
token once, which their own chunk knows: those trigrams, most of all, need not be sent. So what moves is one entry per
distinct n-gram of a chunk, a frequent word weighs no more than a rare one, and no table of counts has to fit anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import UNIT_BYTES, Pool, collect_garbage, fold, input_bytes, lengths, new_id, pick, release_memory, root_sized, stage, stage_by, table
from granary.llm.hashing import joined, pack, pack_sorted, spans, unpack, unpack_sorted, word_hashes

FOLDS, HELD_OUT, TUNING = 7, 2, 3
#: Characters of a chunk, and tokens whose n-grams one counting task handles, about: the least and the most.
CHUNK_BYTES, MOST_CHUNK_BYTES = 4 << 20, 10 << 20
KEYS_PER_RANGE, MOST_PER_RANGE = 400_000, 3_000_000
#: Tokens in a table of UNIT_BYTES, about.
UNIT_TOKENS = 28_000_000
END = np.uint64(0x5E17E17E17E17E1)
#: Steps to the doubling, and doublings below 1, of the cells that weights are learned from; cells keep the mean of what falls in.
GRID, RATIOS, COUNTS = 1, 16, 40
#: Stands for the logarithm of nothing.
NONE = -1000.0
#: Buckets of contexts of one token, and of those of two.
BUCKETS = 66

CHUNK = "chunk long, tuning boolean, n_tokens long, ids binary, folds binary, sizes binary, words binary, codes binary"


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """Documents as rows of many: word hashes (sorted), codes into them, and per document row number, fold and tokens."""

    def chunk(rows: pd.DataFrame, tuning: bool) -> pd.DataFrame:
        h, n = word_hashes(rows["text"].tolist())
        tokens = np.insert(h, np.cumsum(n), END)
        words, codes = np.unique(tokens, return_inverse=True)
        release_memory()
        return pd.DataFrame([{
            "chunk": new_id(), "tuning": tuning, "n_tokens": len(tokens), "ids": pack(rows["row_id"].to_numpy(np.int64)), "folds": rows["fold"].to_numpy(np.uint8).tobytes(),
            "sizes": pack((n + 1).astype(np.int64)), "words": pack(words), "codes": pack(codes.astype(np.uint32)),
        }])

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pools = {True: Pool(chunk_bytes), False: Pool(chunk_bytes)}
        for batch in filter(len, batches):
            for tuning, some in batch.groupby(batch["fold"] == TUNING):
                for rows in pools[bool(tuning)].add(some, lengths(some["text"]).to_numpy()):
                    yield chunk(rows, bool(tuning))
        for tuning, pool in pools.items():
            for rows in pool.rest():
                yield chunk(rows, tuning)

    return docs.mapInPandas(build, CHUNK)


class Chunk:
    """A chunk's tokens and n-grams. unigrams and bigrams are sorted distinct hashes; *_at the place of each token's."""

    def __init__(self, row):
        self.ids, self.folds, self.sizes = unpack(row["ids"], np.int64), np.frombuffer(row["folds"], np.uint8), unpack(row["sizes"], np.int64)
        self.unigrams, self.unigram_at = unpack(row["words"], np.uint64), unpack(row["codes"], np.uint32)
        first = np.cumsum(self.sizes) - self.sizes
        self.first, self.context_at = first, np.roll(self.unigram_at, 1)
        self.context_at[first] = np.searchsorted(self.unigrams, END)  # a document begins after an end
        self.bigrams, self.bigram_at = np.unique(joined(self.unigrams[self.context_at], self.unigrams[self.unigram_at]), return_inverse=True)

    def second_context(self, of_bigrams: np.ndarray) -> np.ndarray:
        """What is said of the two tokens before each; 0 for a document's first."""
        out = np.roll(of_bigrams[self.bigram_at], 1)
        out[self.first] = 0
        return out

    def trigrams(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct hashes of the trigrams that end at the wanted places, and the place of each in these."""
        before = np.roll(self.bigrams[self.bigram_at], 1)[wanted]
        return np.unique(joined(before, self.unigrams[self.unigram_at[wanted]]), return_inverse=True)

    def counts(self, at: np.ndarray, n: int, where: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """How often each n-gram stands in this chunk's documents for counting, and in those for tuning; at: of each token, or of those where."""
        of = np.repeat(self.folds, self.sizes)
        of = of if where is None else of[where]
        return tuple(np.bincount(at[m], minlength=n).astype(np.uint32) for m in ((of != HELD_OUT) & (of != TUNING), of == TUNING))

    def held_out_bigrams(self) -> np.ndarray:
        """Which bigrams stand in a document held out of all counts."""
        out = np.zeros(len(self.bigrams), np.uint8)
        out[self.bigram_at[np.repeat(self.folds, self.sizes) == HELD_OUT]] = 1
        return out


def _send(chunks: DataFrame, bits: int) -> DataFrame:
    """Each chunk's n-grams and their counts in it, a row for each of 2**bits ranges of hashes that has some."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                c, found = Chunk(row), {}
                for name, keys, at in (("uni", c.unigrams, c.unigram_at), ("bi", c.bigrams, c.bigram_at)):
                    a, b = c.counts(at, len(keys))
                    for r, s in zip(*spans(keys, bits), strict=True):
                        found.setdefault(int(r), {}).update({f"{name}_keys": pack_sorted(keys[s]), f"{name}_a": pack(a[s]), f"{name}_b": pack(b[s])})
                held = c.held_out_bigrams()
                for r, s in zip(*spans(c.bigrams, bits), strict=True):
                    found[int(r)]["bi_h"] = pack(held[s])
                out = pd.DataFrame([dict.fromkeys(KINDS, b"") | {"range": r, "chunk": row["chunk"]} | f for r, f in found.items()])
                del c, found
                release_memory()
                yield out

    return chunks.mapInPandas(send, f"range int, chunk long, {', '.join(f'{k} binary' for k in KINDS)}")


KINDS = [*(f"{n}_{k}" for n in ("uni", "bi") for k in ("keys", "a", "b")), "bi_h"]


def _count(group: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of one range's n-grams, for each chunk in its own order: without the tuning documents (a), and with them (t).

    bi_w: whether trigrams that begin with a bigram have to be counted, see Counts.
    """
    out = {"range": group["range"], "chunk": group["chunk"]}
    totals = {k: np.zeros(len(group), np.int64) for k in ("vocabulary_a", "vocabulary_t", "tokens_a", "tokens_t")}
    for name in ("uni", "bi"):
        keys = [unpack_sorted(k) for k in group[f"{name}_keys"]]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        sums = {}
        for k in ("a", "b"):
            own = np.concatenate([unpack(x, np.uint32) for x in group[f"{name}_{k}"]])
            sums[k] = np.bincount(at, weights=own, minlength=len(found)).astype(np.uint64)
        sums["t"] = sums["a"] + sums["b"]
        for k in ("a", "t"):
            out[f"{name}_{k}"] = [pack(x) for x in np.split(sums[k][at], cuts)]
            if name == "uni":  # said once for the range
                totals[f"vocabulary_{k}"][0], totals[f"tokens_{k}"][0] = (sums[k] > 0).sum(), sums[k].sum()
        if name == "bi":
            held = np.zeros(len(found), bool)
            held[at[np.concatenate([unpack(x, np.uint8) for x in group["bi_h"]]) > 0]] = True
            wanted = (sums["t"] > 1) | (held & (sums["t"] > 0))
            out["bi_w"] = [pack(x) for x in np.split(wanted.astype(np.uint8)[at], cuts)]
        del found, at, sums
        release_memory()
    return pd.DataFrame(out | totals)


_COUNTED = "range int, chunk long, uni_a binary, uni_t binary, bi_a binary, bi_t binary, bi_w binary, vocabulary_a long, vocabulary_t long, tokens_a long, tokens_t long"


def _send_trigrams(left: pd.DataFrame, right: pd.DataFrame, bits: int) -> pd.DataFrame:
    """A chunk's trigrams after wanted contexts, and their counts in it, a row for each range that has some."""
    if not len(left):
        return pd.DataFrame(columns=["range", "chunk", "keys", "a", "b"])
    c = Chunk(left.iloc[0])
    wanted = c.second_context(_said(right, "bi_w", np.uint8)) > 0
    keys, at = c.trigrams(wanted)
    a, b = c.counts(at, len(keys), wanted)
    ranges, parts = spans(keys, bits)
    release_memory()
    return pd.DataFrame({
        "range": ranges, "chunk": np.full(len(ranges), left["chunk"].iloc[0]), "keys": [pack_sorted(keys[s]) for s in parts], "a": [pack(a[s]) for s in parts], "b": [pack(b[s]) for s in parts],
    })


def _count_trigrams(group: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of one range's trigrams, for each chunk in its own order."""
    keys = [unpack_sorted(k) for k in group["keys"]]
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    del keys
    a, b = (np.bincount(at, weights=np.concatenate([unpack(x, np.uint32) for x in group[k]]), minlength=len(found)).astype(np.uint64) for k in ("a", "b"))
    out = {f"tri_{k}": [pack(x) for x in np.split(v[at], cuts)] for k, v in (("a", a), ("t", a + b))}
    release_memory()
    return pd.DataFrame({"range": group["range"], "chunk": group["chunk"], **out})


def _said(answers: pd.DataFrame, column: str, dtype: type = np.uint64) -> np.ndarray:
    """A chunk's answers of one kind in the order of its n-grams."""
    rows = answers[answers[column].notna()].sort_values("range")[column]
    return np.concatenate([unpack(x, dtype) for x in rows] or [np.zeros(0, dtype)]).astype(np.float64)


class Counts:
    """For each token of a chunk: the corpus counts of the token, of the one and the two before it, and of it after these.

    Two tokens before that are not wanted were counted never, or once and are in no held-out document. Counted once, they
    stand here only, so they and the trigram have one count. In a tuning document that is none of the counts without these.
    """

    def __init__(self, row, answers: pd.DataFrame, k: str):
        self.chunk = c = Chunk(row)
        uni, bi = _said(answers, f"uni_{k}"), _said(answers, f"bi_{k}")
        self.context, self.pair, self.token = uni[c.context_at], bi[c.bigram_at], uni[c.unigram_at]
        wanted = c.second_context(_said(answers, "bi_w", np.uint8)) > 0
        _, at = c.trigrams(wanted)
        self.second = c.second_context(bi)
        self.triple = self.second.copy()
        self.triple[wanted] = _said(answers, f"tri_{k}")[at]


def bucket(context: np.ndarray, second: np.ndarray) -> np.ndarray:
    """0 for unseen contexts; 1 + the rounded-down base-2 logarithm of the count of one token; that of two tokens, after those of one."""
    level = lambda c: np.where(c > 0, np.frexp(c)[1], 0)
    return np.where(second > 0, BUCKETS + level(second), level(context))


def ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)


def estimates(triple: np.ndarray, pair: np.ndarray, token: np.ndarray, tokens: int, vocabulary: int) -> np.ndarray:
    """The four estimates that are mixed, as columns, from the two conditional ratios and the token's count."""
    floor = (token + 1) / (tokens + vocabulary + 1)
    return np.stack([triple, pair, token / tokens if tokens else floor, floor], axis=1)


def cells(bucket: np.ndarray, triple: np.ndarray, pair: np.ndarray, token: np.ndarray) -> pd.DataFrame:
    """Observations alike in bucket, ratios and count as one row: how many, and the sums of the three logarithms.

    There are at most 2 * BUCKETS * (GRID * RATIOS + 2) ** 2 * (GRID * COUNTS + 2) rows, whatever the corpus.
    """
    log = lambda v: np.where(v > 0, np.log2(np.maximum(v, 1e-300)), NONE)
    logs = [log(triple), log(pair), log(token)]
    step = lambda v, least, most: np.where(v == NONE, 0, 1 + np.rint((np.clip(v, least, most) - least) * GRID)).astype(np.int64)
    r, c = GRID * RATIOS + 2, GRID * COUNTS + 2
    key = ((bucket.astype(np.int64) * r + step(logs[0], -RATIOS, 0)) * r + step(logs[1], -RATIOS, 0)) * c + step(logs[2], 0, COUNTS)
    found, at, n = np.unique(key, return_inverse=True, return_counts=True)
    sums = {name: np.bincount(at, weights=v, minlength=len(found)) for name, v in zip(("triple", "pair", "token"), logs, strict=True)}
    return pd.DataFrame({"cell": found, "bucket": (found // (r * r * c)).astype(np.int32), "n": n, **sums})


CELLS = "cell long, bucket int, n long, triple double, pair double, token double"


def learn_weights(histogram: pd.DataFrame, tokens: int, vocabulary: int, rounds: int = 60) -> np.ndarray:
    """Weights by bucket from cells, summed over chunks.

    Buckets share the weights of all contexts of as many tokens to the extent of one observation of a hundred.
    """
    weights = np.concatenate((np.tile([0, 0.5, 0.4, 0.1], (BUCKETS, 1)), np.tile([0.4, 0.3, 0.2, 0.1], (BUCKETS, 1))))
    weights[0] = [0, 0, 0.5, 0.5]
    if not len(histogram):
        return weights
    b, n = histogram["bucket"].to_numpy(), histogram["n"].to_numpy(float)
    mean = lambda c: histogram[c].to_numpy() / n
    value = lambda c: np.where(mean(c) <= NONE + 1, 0, np.exp2(np.maximum(mean(c), NONE / 2)))
    p = estimates(np.minimum(value("triple"), 1), np.minimum(value("pair"), 1), value("token"), tokens, vocabulary)
    for _ in range(rounds):
        share = weights[b] * p
        share *= (n / share.sum(axis=1))[:, None]
        seen = np.stack([np.bincount(b, weights=s, minlength=2 * BUCKETS) for s in share.T], axis=1)
        for own in (slice(1, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
            total = seen[own].sum()
            every = seen[own].sum(axis=0) / total if total else weights[own.start]
            weights[own] = (seen[own] + 100 * every) / (seen[own].sum(axis=1) + 100)[:, None]
        if seen[0].sum():
            weights[0] = seen[0] / seen[0].sum()
    return weights


def language_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of df.

    Tokens are a text's words, A-Z lower-cased, and an end; a null, empty or blank text is the end alone. Rows whose
    id's crc32 modulo 7 is 2 are scored and never learned from; a null id counts as the empty text. Repeated rows
    count and are scored each. Texts of any length. Other columns are ignored; an empty table gives no rows.
    Without training rows every token has the floor's probability.
    """
    docs = pick(df, id_col, text_col).toDF("doc_id", "text")
    # Ids may be of any type; rows go by their place in the written table of ids.
    docs = docs.select("doc_id", "text", fold(F.col("doc_id"), FOLDS).cast("int").alias("fold"))
    plain = dict(docs.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint")
    if not plain:
        docs = docs.withColumn("row_id", F.monotonically_increasing_id())
        docs = stage(docs, "rows")
    else:
        docs = docs.withColumn("row_id", F.col("doc_id").cast("long"))
    null_id = -(1 << 63)
    keyed = docs.select(F.coalesce("row_id", F.lit(null_id)).alias("row_id"), "text", "fold")
    chunk_bytes = chunk_bytes or root_sized(CHUNK_BYTES, MOST_CHUNK_BYTES, input_bytes(keyed), UNIT_BYTES)
    chunks = stage_by(_chunks(keyed, chunk_bytes), "chunk", "chunks")
    total = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    per_range = root_sized(KEYS_PER_RANGE, MOST_PER_RANGE, total, UNIT_TOKENS)
    bits = max(1, int(np.ceil(np.log2(total / per_range + 1))))
    answers = stage(_send(chunks, bits).groupBy("range").applyInPandas(_count, _COUNTED), "counts")
    sums = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("vocabulary_a", "tokens_a", "vocabulary_t", "tokens_t"))).first()
    vocabulary_a, tokens_a, vocabulary, tokens = sums

    collect_garbage(answers.sparkSession)
    asked = answers.select("chunk", "range", "bi_w").groupBy("chunk")
    third = chunks.groupBy("chunk").cogroup(asked).applyInPandas(lambda x, y: _send_trigrams(x, y, bits), "range int, chunk long, keys binary, a binary, b binary")
    third = stage(third.groupBy("range").applyInPandas(_count_trigrams, "range int, chunk long, tri_a binary, tri_t binary"), "trigrams")
    del asked
    collect_garbage(answers.sparkSession)
    every = answers.drop("vocabulary_a", "vocabulary_t", "tokens_a", "tokens_t").unionByName(third, allowMissingColumns=True)

    def tally(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame(columns=["cell", "bucket", "n", "triple", "pair", "token"])
        c = Counts(left.iloc[0], right, "a")
        out = cells(bucket(c.context, c.second), ratio(c.triple, c.second), ratio(c.pair, c.context), c.token)
        release_memory()
        return out

    tuning = chunks.where("tuning")
    asked = every.select("chunk", "range", "uni_a", "bi_a", "bi_w", "tri_a").join(tuning.select("chunk"), "chunk", "left_semi")
    found = tuning.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInPandas(tally, CELLS)
    found = found.groupBy("cell", "bucket").agg(*(F.sum(c).alias(c) for c in ("n", "triple", "pair", "token")))
    weights = learn_weights(found.orderBy("cell").toPandas(), tokens_a, vocabulary_a)  # of bounded size, see cells

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        n = Counts(left.iloc[0], right, "t")
        c, token = n.chunk, n.token
        p = estimates(ratio(n.triple, n.second), ratio(n.pair, n.context), token, tokens, vocabulary)
        add = lambda v: np.add.reduceat(v, c.first)
        mixed = (weights[bucket(n.context, n.second)] * p).sum(axis=1)
        release_memory()
        return pd.DataFrame({
            "row_id": c.ids, "held_out": c.folds == HELD_OUT, "n_tokens": c.sizes, "n_known": add((token > 0).astype(np.int64)), "train_tokens": tokens,
            "base_score": add(np.log10(p[:, 3])), "score": add(np.log10(mixed)),
        })

    out = chunks.groupBy("chunk").cogroup(every.select("chunk", "range", "uni_t", "bi_t", "bi_w", "tri_t").groupBy("chunk")).applyInPandas(
        score, "row_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    rest = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    if plain:
        id_type = dict(docs.dtypes)["doc_id"]
        return out.select(F.when(F.col("row_id") != null_id, F.col("row_id")).cast(id_type).alias("doc_id"), *rest)
    return stage(out, "scores").join(docs.select("row_id", "doc_id"), "row_id").select("doc_id", *rest)


def op9_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))
