"""Language-model scores: counts gathered by hash shards, smoothed bigrams walked as a backoff automaton."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import groups_for, prepare, stage, text_or_empty

#: The end token; no word holds white space. Its state is also where every text starts.
END = xxhash.xxh64_intdigest(b"\n")
#: Bytes of text whose n-grams are counted together in one batch, and in one hash shard.
BATCH_BYTES, SHARD_BYTES = 24 << 20, 32 << 20
#: Weight of the lower order: a context seen this often trusts both orders alike. Chosen on held-out texts.
BACKOFF = 300.0


def token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all tokens, each text closed by ``END``, and how many tokens each text has."""
    words, sizes = [], []
    for text in texts:
        some = text.encode("utf-8", "surrogatepass").lower().split()
        words += some
        sizes.append(len(some))
    flat = np.empty(len(words), dtype=object)
    flat[:] = words
    codes, unique = pd.factorize(flat)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w) for w in unique], dtype=np.uint64)[codes]
    sizes = np.array(sizes, dtype=np.int64)
    return np.insert(hashes, np.cumsum(sizes), np.uint64(END)), sizes + 1


def contexts(tokens: np.ndarray) -> np.ndarray:
    """The token before each token; texts start after ``END``."""
    return np.r_[np.uint64(END), tokens[:-1]] if len(tokens) else tokens


def pair_hashes(tokens: np.ndarray) -> np.ndarray:
    return contexts(tokens) * np.uint64(0x9E3779B97F4A7C15) + tokens * np.uint64(0xC2B2AE3D27D4EB4F)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of the hash, so that sorted hashes stay in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def encode_counts(counts: np.ndarray) -> bytes:
    """Small counts in a byte each; 255 stands for a count that follows after all bytes."""
    large = counts >= 255
    return np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype("<i8").tobytes()


def decode_counts(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<i8", -1, n)
    return out


class BackoffAutomaton:
    """Smoothed bigrams as a weighted automaton over the n-grams that a batch of texts meets.

    Every word is a state. A seen bigram is an arc with weight log10((c(u,w) + k p(w)) / (c(u) + k)); from every state
    a failure arc with weight log10(k / (c(u) + k)) leads to the root, whose arcs carry log10 p(w). With the Dirichlet
    prior the arcs of a state sum to one. p(w) gives unknown words together the share of words seen once (Good-Turing).
    """

    def __init__(self, words: np.ndarray, word_counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray,
                 train_tokens: int, singles: int, backoff: float = BACKOFF):
        unknown = max(singles, 1) / (train_tokens + 1)
        known = (1 - unknown) * word_counts / max(train_tokens, 1)
        self.words, self.counts = words, word_counts
        self.root = np.log10(np.where(word_counts > 0, known, unknown))
        self.fail = np.log10(backoff / (word_counts + backoff))
        self.pairs, self.pair_counts, self.backoff = pairs, pair_counts, backoff

    def walk(self, tokens: np.ndarray) -> np.ndarray:
        """The weight each token adds, left to right; the state after a token is its word."""
        word = np.searchsorted(self.words, tokens)
        state = np.searchsorted(self.words, contexts(tokens))
        seen = self.pair_counts[np.searchsorted(self.pairs, pair_hashes(tokens))]
        backed_off = self.fail[state] + self.root[word]
        arc = np.log10((seen + self.backoff * 10.0 ** self.root[word]) / (self.counts[state] + self.backoff))
        return np.where(seen > 0, arc, backed_off)


def _batched(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, train, batch): batches never cross a file block, so a scan task holds whole batches."""
    slim = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    try:
        if "_metadata" in docs.columns:
            raise AnalysisException("a column hides the file metadata")
        slim = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"),
                           F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"))
    except AnalysisException:  # not read from files
        slim = stage(slim, "texts").select(
            "id", "text", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"))
    block = docs.sparkSession.conf.get("spark.sql.files.maxPartitionBytes")
    block = docs.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(block)
    parts = groups_for(3 * block, BATCH_BYTES)  # text is about three times its compressed size
    train = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % 7 != 2
    return slim.select("id", "text", train.alias("train"),
                       F.xxhash64("f", "b", F.pmod(F.xxhash64("id"), F.lit(parts))).alias("batch"))


def _collect(chunks: Iterator[pd.DataFrame]) -> Iterator[tuple[int, list]]:
    """Runs of rows of one batch."""
    key, held = None, []
    for chunk in chunks:
        for k, rows in chunk.groupby("batch", sort=False):
            if k != key and held:
                yield key, held
                held = []
            key = k
            held.append(_hashed(rows))
    if held:
        yield key, held


def _hashed(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    tokens, sizes = token_hashes(rows["text"].tolist())
    return tokens, pair_hashes(tokens), sizes, np.repeat(rows["train"].to_numpy(), sizes)


def counts(batched: DataFrame, shards: int) -> DataFrame:
    """(kind, shard, batch, counts, types, tokens, singles): training counts for every n-gram each batch asks for.

    A batch asks each hash shard for its distinct n-grams, in hash order, and tells how often it holds them in training
    texts. The shard adds up all batches and answers with the totals in the same order. So a frequent n-gram is one
    row per batch, whatever its count, and no task holds more than one batch or one shard. One row per shard, with
    NULL batch, carries the number of types, tokens and types seen once.
    """

    def ask(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, held in _collect(chunks):
            train = np.concatenate([h[3] for h in held])
            for kind in (0, 1):
                found, at = np.unique(np.concatenate([h[kind] for h in held]), return_inverse=True)
                n = np.bincount(at[train], minlength=len(found))
                shard = shard_of(found, shards)
                cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
                rows = [(kind, int(shard[lo]), batch, found[lo:hi].tobytes(), encode_counts(n[lo:hi]))
                        for lo, hi in zip(cuts, [*cuts[1:], len(found)], strict=True)]
                yield pd.DataFrame(rows, columns=["kind", "shard", "batch", "hashes", "counts"])

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        asked = [np.frombuffer(h, np.uint64) for h in part["hashes"]]
        sizes = [len(a) for a in asked]
        own = np.concatenate([decode_counts(c, n) for c, n in zip(part["counts"], sizes, strict=True)])
        found, at = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(at, weights=own, minlength=len(found)).astype(np.int64)
        kind, shard = int(part["kind"].iloc[0]), int(part["shard"].iloc[0])
        stops = np.cumsum(sizes)
        rows = [(kind, shard, b, encode_counts(total[at[hi - n:hi]]), None, None, None)
                for b, n, hi in zip(part["batch"], sizes, stops, strict=True)]
        rows.append((kind, shard, None, None, int((total > 0).sum()), int(total.sum()), int((total == 1).sum())))
        return pd.DataFrame(rows, columns=["kind", "shard", "batch", "counts", "types", "tokens", "singles"],
                            dtype=object)

    requests = batched.sortWithinPartitions("batch").mapInPandas(
        ask, "kind int, shard int, batch long, hashes binary, counts binary")
    return requests.groupBy("kind", "shard").applyInPandas(
        answer, "kind int, shard int, batch long, counts binary, types long, tokens long, singles long")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", backoff: float = BACKOFF) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Training texts are those whose crc32(id as text) leaves another remainder than 2 by 7 (NULL id: as empty text).
    NULL text counts as empty: one end token. Repeated rows count each time, in training and in the result. With no
    training text every word is unknown. An empty table gives no rows. Other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    batched = _batched(docs, id_col, text_col)
    size = batched.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = groups_for(size, SHARD_BYTES)
    answers = stage(counts(batched, shards), "counts")
    sums = answers.where("batch IS NULL AND kind = 0").agg(
        F.sum("types"), F.sum("tokens"), F.sum("singles")).first()
    types, tokens, singles = (int(x or 0) for x in sums)
    kind = batched.schema["id"].dataType.simpleString()

    def run(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        held = _hashed(rows)
        grams = [np.unique(held[k]) for k in (0, 1)]
        known = []
        for k in (0, 1):
            shard = shard_of(grams[k], shards)
            of = dict(zip(replies["shard"][replies["kind"] == k], replies["counts"][replies["kind"] == k], strict=True))
            known.append(np.concatenate([decode_counts(of[s], n) for s, n in zip(*(
                x.tolist() for x in np.unique(shard, return_counts=True)), strict=True)]))
        machine = BackoffAutomaton(grams[0], known[0], grams[1], known[1], tokens, singles, backoff)
        seen = known[0][np.searchsorted(grams[0], held[0])]
        starts = np.r_[0, np.cumsum(held[2])[:-1]]
        add = lambda x: np.add.reduceat(x, starts)
        return pd.DataFrame({
            "id": rows["id"], "held_out": ~rows["train"], "n_tokens": held[2],
            "n_known": add((seen > 0).astype(np.int64)), "train_tokens": tokens,
            "base_score": add(np.log10((seen + 1.0) / (tokens + types + 1.0))), "score": add(machine.walk(held[0]))})

    replies = answers.where("batch IS NOT NULL").select("kind", "shard", "batch", "counts")
    return batched.groupBy("batch").cogroup(replies.groupBy("batch")).applyInPandas(
        run, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
             "score double").withColumnRenamed("id", id_col)
