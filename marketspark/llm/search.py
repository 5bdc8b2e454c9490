"""Exact top-k BM25: inverted index with bounds per group of like documents, merged under global statistics."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import groups_for, prepare, stage, text_or_empty

K1, B = 1.2, 0.75
#: Documents in a shard's index, in a group of it and in a block of a group.
SHARD_DOCS, GROUP_DOCS, BLOCK_DOCS = 8192, 512, 128
#: Words of which a query is expected to read so many postings in a group or more, up to a number of words, are scored for all of
#: its documents at once: so much longer is a posting than a multiplication for every document of the group.
COMMON_POSTINGS, COMMON_WORDS = 1.0, 2048
#: Queries scored at once.
BATCH = 128
#: Distinct query terms (with repeats across queries) handled in one pass over the documents.
PASS_TERMS = 2_000_000
#: Scores are compared at this precision, so equal documents tie whatever the order of their sums.
DIGITS = 9
_SLACK = 10.0 ** -DIGITS
_WORD = re.compile(r"[^\W_]+")


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[0], lo[0]+1, ... n[0] of them, then from lo[1], and so on."""
    places = np.repeat(lo - np.cumsum(n) + n, n)
    places += np.arange(len(places))
    return places


def vectors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, length, terms, counts, level): the hashes of a document's distinct words, ascending, and how often it has them.

    Of a task's rows every 64th is of level 2, every other 8th of level 1, the rest of level 0.
    """
    slim = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest, seen = xxhash.xxh64_intdigest, 0
        for part in parts:
            number = np.arange(seen, seen + len(part))
            seen += len(part)
            words, sizes = [], []
            for text in part["text"]:
                own = _WORD.findall(text.lower())
                words += own
                sizes.append(len(own))
            flat = np.empty(len(words), dtype=object)
            flat[:] = words
            codes, unique = pd.factorize(flat)
            hashes = np.array([digest(w.encode("utf-8", "surrogatepass")) for w in unique], dtype=np.uint64)
            order = np.argsort(hashes)
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            doc = np.repeat(np.arange(len(sizes)), sizes)
            pairs, counts = np.unique(doc * max(1, len(unique)) + rank[codes], return_counts=True)
            cuts = np.searchsorted(pairs, np.arange(len(sizes) + 1) * max(1, len(unique)))
            terms = hashes[order][pairs % max(1, len(unique))] if len(pairs) else hashes
            counts = counts.astype("<u4")
            yield pd.DataFrame({
                "id": part["id"], "length": sizes,
                "terms": [terms[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
                "counts": [counts[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
                "level": (number % 8 == 7).astype("int32") + (number % 64 == 63)})

    return slim.mapInPandas(run, f"id {kind}, length long, terms binary, counts binary, level int")


class Lookup:
    """Places of words in a sorted vocabulary. Words are hashes, so their first bits tell nearly where they stand."""

    def __init__(self, vocabulary: np.ndarray):
        bits = max(1, len(vocabulary).bit_length())
        self.vocabulary, self.shift = np.r_[vocabulary, np.uint64(2**64 - 1)], np.uint64(64 - bits)
        self.first = np.searchsorted(vocabulary, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def __call__(self, words: np.ndarray) -> np.ndarray:
        """The place of every word, -1 for those not in the vocabulary."""
        at = self.first[words >> self.shift]
        behind = np.flatnonzero(self.vocabulary[at] < words)
        while len(behind):
            at[behind] += 1
            behind = behind[self.vocabulary[at[behind]] < words[behind]]
        at[(self.vocabulary[at] != words) | (at == len(self.vocabulary) - 1)] = -1
        return at


def _commonest(terms: list[np.ndarray], counts: list[np.ndarray]) -> np.ndarray:
    """Each row's commonest word, 0 without words."""
    return np.array([t[c.argmax()] if len(t) else 0 for t, c in zip(terms, counts, strict=True)], dtype=np.uint64)


def _alike(top: np.ndarray, *then: np.ndarray) -> np.ndarray:
    """An order in which rows of the same commonest word stand together, the most frequent such words first."""
    _, place, often = np.unique(top, return_inverse=True, return_counts=True)
    return np.lexsort([*then, place, -often[place]])


class Queries:
    """A block of queries: ids, and each one's terms (numbers in ``vocabulary``) with their weights; like ones stand together."""

    def __init__(self, rows: list[tuple[object, np.ndarray, np.ndarray]]):
        rows = [rows[i] for i in _alike(_commonest([r[1] for r in rows], [r[2] for r in rows]))]
        self.ids = [r[0] for r in rows]
        self.vocabulary = np.unique(np.concatenate([r[1] for r in rows] or [np.zeros(0, np.uint64)]))
        self.terms = [np.searchsorted(self.vocabulary, r[1]).astype(np.int32) for r in rows]
        self.weights = [r[2].astype(np.float64) for r in rows]
        #: The share of queries that have a word.
        self.chance = np.bincount(np.concatenate(self.terms or [np.zeros(0, np.int32)]), minlength=len(self.vocabulary)) / max(1, len(rows))

    def weigh(self, frequency: np.ndarray, documents: int) -> None:
        idf = np.log1p((documents - frequency + 0.5) / (frequency + 0.5))
        self.weights = [w * idf[t] for t, w in zip(self.terms, self.weights, strict=True)]


class Shard:
    """Inverted index of some documents, restricted to the words of a block of queries.

    Documents of like vocabulary and length stand together in groups. Rare words are summed first, posting by posting. The common
    ones of a group are one matrix product for many queries, left out where the largest sum of rare words in a block and the
    largest contribution there of each common one don't reach the floor, as in groups of another language or of short documents.
    """

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, terms: list[np.ndarray], counts: list[np.ndarray],
                 vocabulary: np.ndarray, average: float, lookup: Lookup | None = None, chance: np.ndarray | None = None):
        order = _alike(_commonest(terms, counts), lengths)
        self.ids = ids[order]
        n = len(order)
        sizes = np.array([len(terms[d]) for d in order], dtype=np.int64)
        at = (lookup or Lookup(vocabulary))(np.concatenate([terms[d] for d in order] or [np.zeros(0, np.uint64)]))
        known = at >= 0
        doc = np.repeat(np.arange(n), sizes)[known]
        tf = np.concatenate([counts[d] for d in order] or [np.zeros(0, "<u4")])[known].astype(np.float64)
        at = at[known]
        # Words are numbered among those of the shard, the commonest first; the last number stands for all others.
        seen = np.bincount(at, minlength=len(vocabulary))
        here = np.argsort(-seen, kind="stable")[:np.count_nonzero(seen)]
        self.words = len(here)
        self.number = np.full(len(vocabulary), self.words, dtype=np.int32)
        self.number[here] = np.arange(self.words, dtype=np.int32)
        # By document, for exact scores.
        self.word = self.number[at]
        self.gain = tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[order][doc] / max(average, 1e-9)))
        self.of_doc = np.r_[0, np.cumsum(np.bincount(doc, minlength=n))]
        self.weight = np.zeros(self.words + 1)
        by = np.argsort(self.word, kind="stable")
        word, doc, gain = self.word[by], doc[by], self.gain[by]
        # Common words of a group: a dense row each, so that one matrix product scores them for all its documents and many queries.
        self.edges = np.arange(0, n, GROUP_DOCS)
        group = doc // GROUP_DOCS
        often = np.bincount(word * np.int64(len(self.edges)) + group, minlength=(self.words + 1) * len(self.edges))
        often = often.reshape(self.words + 1, len(self.edges))
        self.row = np.full((len(self.edges), self.words + 1), -1, dtype=np.int16)
        chance = np.r_[often[:-1].sum(axis=1) / n if chance is None else chance[here], 0.0]
        for g in range(len(self.edges)):
            read = often[:, g] * chance
            common = np.flatnonzero(read >= COMMON_POSTINGS)
            common = common[np.argsort(-read[common], kind="stable")[:COMMON_WORDS]]
            self.row[g, common] = np.arange(len(common))
        self.shared = (self.row >= 0).any(axis=0)
        row = self.row[group, word]
        rare = row < 0
        self.dense = []
        for g, edge in enumerate(self.edges):
            mine = np.flatnonzero(~rare & (group == g))
            dense = np.zeros((int(self.row[g].max(initial=-1)) + 1, min(GROUP_DOCS, n - edge)), dtype=np.float32)
            dense[row[mine], doc[mine] - edge] = gain[mine]
            self.dense.append(dense)
        # The largest gain of a common word in every block.
        self.blocks = np.arange(0, n, BLOCK_DOCS)
        self.shared_number = np.cumsum(self.shared) - 1
        place, held = self.shared_number[word[~rare]] * len(self.blocks) + doc[~rare] // BLOCK_DOCS, gain[~rare]
        self.most = np.zeros((int(self.shared.sum()) + 1) * len(self.blocks), dtype=np.float32)
        new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else place
        if len(new):
            self.most[place[new]] = np.maximum.reduceat(held, new)
        self.most = self.most.reshape(-1, len(self.blocks))
        # Postings of all others.
        self.posting = np.rec.fromarrays([doc[rare].astype(np.uint32), gain[rare].astype(np.float32)]).view(np.uint64)
        self.size = np.bincount(word[rare], minlength=self.words + 1)
        self.start = np.cumsum(self.size) - self.size

    def best(self, terms: list[np.ndarray], weights: list[np.ndarray], k: int,
             floors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For every query the (documents, scores) that may be among its best ``k`` given that scores under its floor are not.

        Scores are first summed at single precision; all are sums of positive numbers, so their error is a share of them that the
        number of terms bounds. What reaches the floor less that share is summed again at double precision.
        """
        n, wide = len(self.ids), len(terms)
        sure = np.array([1 - (len(t) + 16) * 2.0 ** -23 for t in terms])
        least = np.where(floors > 0, (floors - _SLACK) * sure, 0.0)
        active = np.zeros((wide, len(self.edges)), dtype=bool)
        score = np.zeros((wide, n), dtype=np.float32)
        asked = []
        for q, (t, w) in enumerate(zip(terms, weights, strict=True)):
            word = self.number[t]
            here = word < self.words
            word, w = word[here], w[here].astype(np.float32)
            if not len(word):
                continue
            many = self.size[word]
            posting = self.posting[_ranges(self.start[word], many)]
            score[q] = np.bincount(posting.view(np.uint32)[::2], posting.view(np.float32)[1::2] * np.repeat(w, many), minlength=n)
            common = np.flatnonzero(self.shared[word])
            word, w = word[common], w[common]
            bound = np.maximum.reduceat(score[q], self.blocks) + w @ self.most[self.shared_number[word]]
            reach = (bound > 0) & (bound >= least[q] * sure[q])
            active[q] = np.logical_or.reduceat(reach, self.edges // BLOCK_DOCS)
            asked.append((np.full(len(word), q), word, w))
        none = np.zeros(0, np.int64), np.zeros(0)
        if not active.any():
            return [none] * wide
        query, word, weight = (np.concatenate(c) for c in zip(*asked, strict=True))
        hits = []
        for g in np.flatnonzero(active.any(axis=0)):
            rows = np.flatnonzero(active[:, g])
            place = np.cumsum(active[:, g]) - 1
            row = self.row[g][word]
            mine = np.flatnonzero((row >= 0) & active[query, g])
            dense = self.dense[g]
            wanted = np.zeros((len(rows), len(dense)), dtype=np.float32)
            wanted[place[query[mine]], row[mine]] = weight[mine]
            edge = self.edges[g]
            total = wanted @ dense
            total += score[rows, edge:edge + dense.shape[1]]
            hit = (total >= least[rows, None]) & (total > 0)
            full = np.flatnonzero(hit.sum(axis=1) > k)
            if len(full):
                # More than k documents reach the floor: the k-th of them is a higher one.
                kth = np.partition(total[full], -k, axis=1)[:, -k].astype(np.float64)
                own = rows[full]
                least[own] = np.maximum(least[own], (kth * sure[own] - _SLACK) * sure[own])
                hit[full] &= total[full] >= least[own, None]
            at, d = np.nonzero(hit)
            hits.append((rows[at], d + edge, total[at, d]))
        q, d, total = (np.concatenate(c) for c in zip(*hits, strict=True))
        left = total >= least[q]
        q, d = q[left], d[left]
        by = np.argsort(q, kind="stable")
        cuts = np.searchsorted(q[by], np.arange(wide + 1))
        return [self._exact(terms[i], weights[i], d[by[a:b]]) if b > a else none
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]

    def _exact(self, terms: np.ndarray, weights: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``docs`` and their scores at double precision."""
        word = self.number[terms]
        self.weight[word], self.weight[-1] = weights, 0.0
        size = self.of_doc[docs + 1] - self.of_doc[docs]
        at = _ranges(self.of_doc[docs], size)
        total = np.bincount(np.repeat(np.arange(len(docs)), size), self.weight[self.word[at]] * self.gain[at], minlength=len(docs))
        self.weight[word] = 0.0
        return docs, np.round(total, DIGITS)

    def common(self, terms: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
        """Score of every document from the common words of its group alone, a row per query."""
        score = np.zeros((len(terms), len(self.ids)))
        for q, (t, w) in enumerate(zip(terms, weights, strict=True)):
            for g, dense in enumerate(self.dense):
                row = self.row[g][self.number[t]]
                score[q, self.edges[g]:self.edges[g] + dense.shape[1]] = w[row >= 0] @ dense[row[row >= 0]]
        return score

    def top(self, terms: np.ndarray, weights: np.ndarray, base: np.ndarray, k: int,
            floor: float) -> tuple[np.ndarray, np.ndarray]:
        """``best`` of one query."""
        return self.best([terms], [weights], k, np.array([floor]))[0]


def _shards(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of a task in shards of ``SHARD_DOCS``, the last one up to half larger or smaller: a small one costs nearly as much."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part)
        if n >= SHARD_DOCS * 3 // 2:
            rows = pd.concat(held, ignore_index=True)
            yield rows[:SHARD_DOCS]
            held, n = [rows[SHARD_DOCS:]], n - SHARD_DOCS
    if n:
        yield pd.concat(held, ignore_index=True)


def _blocks(queries: DataFrame) -> Iterator[Queries]:
    rows, n = [], 0
    for r in queries.select("id", "terms", "counts").toLocalIterator():
        rows.append((r[0], np.frombuffer(r[1], np.uint64), np.frombuffer(r[2], "<u4")))
        n += len(rows[-1][1])
        if n >= PASS_TERMS:
            yield Queries(rows)
            rows, n = [], 0
    if rows:
        yield Queries(rows)


def _frequencies(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """In how many documents each word of the block occurs, over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = shared.value
        lookup, total = Lookup(words), np.zeros(len(words), dtype=np.int64)
        for part in parts:
            at = lookup(np.frombuffer(b"".join(part["terms"]), np.uint64))
            total += np.bincount(at[at >= 0], minlength=len(words))
        for lo in range(0, len(words), 1 << 16):
            yield pd.DataFrame({"part": [lo], "counts": [total[lo:lo + (1 << 16)].tobytes()]})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in rows["counts"])
        return pd.DataFrame({"part": rows["part"].iloc[:1], "counts": [total.tobytes()]})

    kind = "part long, counts binary"
    found = docs.select("terms").mapInPandas(count, kind).groupBy("part").applyInPandas(add, kind).collect()
    return np.concatenate([np.frombuffer(r[1], np.int64) for r in sorted(found, key=lambda r: r[0])]) if found else \
        np.zeros(len(vocabulary), np.int64)


def _rounds(documents: int) -> list[list[int]]:
    """The levels of documents searched together, the few first: their answers are the floors of the many.

    Level 0 is seven eighths of the documents, level 1 seven eighths of the rest.
    """
    return [[2], [1], [0]] if documents >= 16 * SHARD_DOCS else [[0, 1, 2]]


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(query_id, rank, id_col, score): the ``k`` best documents of every query by BM25, ties to the smaller id.

    Exact: whatever is skipped has an upper bound below a score that k documents reach. Documents without a word of the query are
    no answers, so a query may have fewer than ``k``, and an empty or NULL text has none. Repeated documents compete row by row;
    repeated query ids are one query, the first of them; queries with NULL id are ignored. Either table may be empty. Other columns are
    ignored. Queries are handled in blocks of at most ``PASS_TERMS`` terms (24 MB), each sent to all tasks; documents do not move.
    Documents are searched in three rounds, few in one: the k-th best score of a query so far is its floor in the next round, so that a task
    of the last round, with most of the documents, returns few rows however many tasks there are.
    """
    spark = prepare(docs.sparkSession)
    vecs = stage(vectors(docs, id_col, text_col), "vectors", partition_by=("level",))
    asked = vectors(queries.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]), id_col, text_col)
    asked = asked.where("length > 0")
    held = vecs.groupBy("level").agg(F.count("*"), F.sum("length")).collect()
    n = sum(rows for _, rows, _ in held)
    average = sum(length for _, _, length in held) / max(1, n)
    kind = vecs.schema["id"].dataType.simpleString()
    schema = f"query_id {kind}, id {kind}, score double, place int"
    found = None

    def search(block, levels: list[int], known: np.ndarray) -> DataFrame:
        sent = spark.sparkContext.broadcast(known)

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            asked = block.value
            lookup = Lookup(asked.vocabulary)
            best: list = [None] * len(asked.ids)
            floors = sent.value.copy()
            for part in _shards(parts):
                ids = part["id"].to_numpy()
                shard = Shard(np.arange(len(ids)), part["length"].to_numpy(),
                              [np.frombuffer(t, np.uint64) for t in part["terms"]],
                              [np.frombuffer(c, "<u4") for c in part["counts"]], asked.vocabulary, average, lookup, asked.chance)
                for first in range(0, len(asked.ids), BATCH):
                    now = slice(first, first + BATCH)
                    answers = shard.best(asked.terms[now], asked.weights[now], k, floors[now])
                    for q, (doc, score) in enumerate(answers, first):
                        doc, score = doc[score >= floors[q]], score[score >= floors[q]]
                        if not len(doc):
                            continue
                        own = ids[shard.ids[doc]]
                        if best[q] is not None:
                            own, score = np.r_[best[q][0], own], np.r_[best[q][1], score]
                        keep = np.lexsort([own, -score])[:k]  # a NULL id arrives as NaN and sorts last
                        best[q] = (own[keep], score[keep])
                        if len(keep) == k:
                            floors[q] = max(floors[q], best[q][1][-1])
            rows = [(asked.ids[q], d, s, q) for q, found in enumerate(best) if found for d, s in zip(*found, strict=True)]
            if rows:
                yield pd.DataFrame(rows, columns=["query_id", "id", "score", "place"])

        # A task holds a shard at least, if that leaves work for every core: each shard costs a query its look-ups.
        shards = groups_for(sum(rows for level, rows, _ in held if level in levels), SHARD_DOCS)
        chosen = vecs.where(F.col("level").isin(levels)).drop("level")
        return chosen.coalesce(max(shards, spark.sparkContext.defaultParallelism)).mapInPandas(run, schema)

    for block in _blocks(asked):
        block.weigh(_frequencies(vecs, block.vocabulary), n)
        shared, floors, mine = spark.sparkContext.broadcast(block), np.full(len(block.ids), -np.inf), None
        for levels in _rounds(n):
            one = stage(search(shared, levels, floors), "answers")
            mine = one if mine is None else mine.union(one)
            if 0 not in levels:
                kth = F.get(F.sort_array(F.collect_list("score"), asc=False), F.lit(k - 1)).alias("kth")
                for place, score in mine.groupBy("place").agg(kth).where("kth IS NOT NULL").collect():
                    floors[place] = score
        found = mine if found is None else found.union(mine)
    if found is None:
        found = spark.createDataFrame([], schema)
    ranked = found.withColumn("rank", F.expr(
        "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id ASC NULLS LAST)"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
