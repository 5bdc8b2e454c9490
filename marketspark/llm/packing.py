"""Best-fit packing of token sequences in bulk-synchronous rounds over size ranges."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.llm.common import groups_for, prepare, stage, text_or_empty
from marketspark.llm.tokens import word_bpe

#: Pieces dealt to one cell; a cell is packed by itself, and wastes less than one sequence.
CELL_PIECES = 50_000
#: A round handles the pieces longer than capacity / 2, then / 4, and so on; the last takes the rest.
ROUNDS = 5

_STATE = T.StructType([
    T.StructField("cell", T.IntegerType()),
    T.StructField("kind", T.StringType()),      # gap, place
    T.StructField("length", T.LongType()),      # of the gap, or of each placed piece
    T.StructField("rank", T.LongType()),        # place: first rank among the cell's pieces of this length
    T.StructField("n", T.LongType()),           # gap: bins; place: pieces
    T.StructField("each", T.LongType()),        # place: pieces side by side in one bin
    T.StructField("bin", T.LongType()),         # first bin
    T.StructField("offset", T.LongType()),      # place: where the first piece of a bin starts
])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, capacity: int = 4096, end_id: int = 1, tokenizer: str | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, piece, start, length, ids_crc32): the token ids of each text and ``end_id``, cut at ``capacity``."""
    path = tokenizer or default_tokenizer()
    slim = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = word_bpe(path)
        for part in batches:
            out = []
            for key, ids in zip(part["id"], coder.encode(part["text"].tolist()), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at:at + 4 * capacity]
                    out.append((key, k, at // 4, len(cut) // 4, zlib.crc32(cut)))
            yield pd.DataFrame(out, columns=["id", "piece", "start", "length", "ids_crc32"])

    return slim.mapInPandas(run, f"id {kind}, piece int, start long, length long, ids_crc32 long").withColumnRenamed(
        "id", id_col)


def sweep(lengths: list[tuple[int, int]], gaps: list[tuple[int, int, int]], bins: int, capacity: int):
    """Best fit, longest first, for runs of equal pieces: [(length, n)] into [(gap, first bin, bins)].

    Each run goes to its successor among the gaps, the smallest that holds it; equal pieces take the bins of a run by
    rank. A bin takes as many of the run as fit, which is what placing them one by one does. Pieces without a gap open
    new bins from number ``bins`` on. Returns the placements, the gaps left, and the next bin number.
    """
    sizes: list[int] = []
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    places = []

    def give(gap: int, first: int, n: int) -> None:
        if gap and n:
            if not runs[gap]:
                insort(sizes, gap)
            runs[gap].append((first, n))

    for gap, first, n in sorted(gaps, key=lambda g: (g[0], -g[1])):
        give(gap, first, n)
    for length, n in sorted(lengths, reverse=True):
        rank = 0
        while n:
            k = bisect_left(sizes, length)
            if k < len(sizes):
                gap = sizes[k]
                first, free = runs[gap].pop()
                if not runs[gap]:
                    sizes.pop(k)
            else:
                gap, first, free = capacity, bins, -(-n // (capacity // length))
                bins += free
            each = gap // length
            full = min(n // each, free)
            if full:
                places.append((length, rank, full * each, each, first, capacity - gap))
                rank, n = rank + full * each, n - full * each
                give(gap - each * length, first, full)
                first, free = first + full, free - full
            if free and n and n < each:
                places.append((length, rank, n, n, first, capacity - gap))
                give(gap - n * length, first, 1)
                first, free, rank, n = first + 1, free - 1, rank + n, 0
            give(gap, first, free)
    return places, [(g, first, n) for g in sizes for first, n in runs[g]], bins


def assign(lengths: DataFrame, capacity: int, rounds: int = ROUNDS) -> DataFrame:
    """Placements for ``lengths`` (cell, length, n): which ranks of a length go to which bins, and where.

    Documents and gaps are kept as runs of equal size, so a cell never holds more than a few rows per size, however
    many pieces it has. A round sorts one range of lengths and the gaps of each cell, matches them in a sweep, and hands
    the new gaps to the next round; cells run in parallel, and each round is written out before the next.
    """
    spark: SparkSession = lengths.sparkSession
    state = spark.createDataFrame([], _STATE)
    upper = capacity
    for r in range(rounds):
        lower = capacity >> (r + 1) if r < rounds - 1 else 0
        docs = lengths.where((F.col("length") <= upper) & (F.col("length") > lower)).select(
            "cell", F.lit("doc").alias("kind"), "length", F.lit(0).cast("long").alias("rank"), "n",
            F.lit(0).cast("long").alias("each"), F.lit(0).cast("long").alias("bin"),
            F.lit(0).cast("long").alias("offset"))

        def run(key, part: pd.DataFrame) -> pd.DataFrame:
            doc, gap = part[part["kind"] == "doc"], part[part["kind"] == "gap"]
            # The row of kind "next" carries the cell's next bin number.
            nxt = part.loc[part["kind"] == "next", "bin"]
            places, gaps, bins = sweep(
                list(zip(doc["length"].tolist(), doc["n"].tolist(), strict=True)),
                list(zip(gap["length"].tolist(), gap["bin"].tolist(), gap["n"].tolist(), strict=True)),
                int(nxt.max()) if len(nxt) else 0, capacity)
            cell = int(key[0])
            rows = [(cell, "place", *p) for p in places] + [(cell, "gap", g, 0, n, 0, b, 0) for g, b, n in gaps]
            rows.append((cell, "next", 0, 0, 0, 0, bins, 0))
            new = pd.DataFrame(rows, columns=_STATE.names)
            return pd.concat([part[part["kind"] == "place"], new], ignore_index=True)

        state = stage(state.union(docs).groupBy("cell").applyInPandas(run, _STATE), "packed")
        upper = lower
    return state.where("kind = 'place'").drop("kind")


def pack(docs: DataFrame, capacity: int = 4096, end_id: int = 1, tokenizer: str | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every text with its place: (id_col, piece, start, length, ids_crc32, sequence_id, offset).

    Only texts longer than ``capacity`` are cut. NULL and empty texts are one piece with ``end_id`` alone; repeated
    rows and NULL ids are packed like any other row; an empty table gives no rows; other columns are ignored.
    A sequence is filled from 0 without gaps. Pieces of full length are sequences of their own and are not dealt.
    """
    prepare(docs.sparkSession)
    cut = pieces(docs, capacity, end_id, tokenizer, id_col, text_col)
    numbered = stage(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    short = numbered.where(F.col("length") < capacity)
    cells = groups_for(short.count(), CELL_PIECES)
    short = short.withColumn("cell", F.pmod(F.xxhash64("row"), F.lit(cells)).cast("int"))
    places = assign(short.groupBy("cell", "length").agg(F.count("*").alias("n")), capacity)
    ranked = short.withColumn("at", F.expr("row_number() OVER (PARTITION BY cell, length ORDER BY row) - 1L"))
    p = places.select("cell", "length", "rank", "n", "each", "bin", "offset")
    step = F.col("at") - F.col("rank")
    placed = ranked.join(p, ["cell", "length"]).where((step >= 0) & (step < F.col("n"))).select(
        id_col, "piece", "start", "length", "ids_crc32",
        ((F.col("bin") + F.expr("(at - rank) div each")) * cells + F.col("cell")).alias("sequence_id"),
        (F.col("offset") + step % F.col("each") * F.col("length")).alias("offset"))
    full = numbered.where(F.col("length") == capacity).select(
        id_col, "piece", "start", "length", "ids_crc32", (-F.col("row") - 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return placed.union(full)
