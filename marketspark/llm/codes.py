"""Short codes for vectors: product quantisation by Lloyd rounds over partition-local cover trees.

A block of rows has one cover tree for each part of its vectors. A node stands for its own point and all points below it, within a
known radius, and keeps their sums. If the nearest codebook entry of a node stays nearest for everything within the radius
(triangle inequality), the whole subtree is assigned by its sums; only nodes for which this is open hand the question down, and
single points are compared exactly. All arithmetic on points is on integers, so results do not depend on how rows are dealt out.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import arrow_rows, prepare, stage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Rows of a block, and points that become leaves without a further split.
BLOCK_ROWS, LEAF = 4096, 12
#: Blocks handed to a worker at once.
BLOCKS = 4
#: Components from this size on are treated like infinite ones: sums of any number of smaller ones fit 38 digits.
LARGEST = 1e22


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), as 64-bit integers where they fit well, else as Python integers."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if np.abs(scaled).max(initial=0) < 1 << 40:
        return scaled.astype(np.int64)
    return np.array([int(x) for x in scaled.ravel()], dtype=object).reshape(scaled.shape)


def narrow(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The points in a type in which squared distances to the entries are exact."""
    most = max(1, *(int(np.abs(x).max(initial=0)) for x in (points, entries)))
    return points if points.dtype != object and (2 * most) ** 2 * points.shape[1] < 1 << 62 else points.astype(object)


class CoverTree:
    """Nodes in depth-first order, so a subtree is the range from a node to its ``stop``.

    ``row`` is the point of a node; ``own`` is 0 where a node only repeats its parent's point as the centre of what is near it.
    Children lie within half the radius of their parent's ball, each around a centre of its own.
    """

    FIELDS = ("row", "own", "stop", "parent", "radius")

    def __init__(self, **fields: np.ndarray):
        self.__dict__.update(fields)
        inner = np.arange(1, len(self.row))
        self.children = inner[np.argsort(self.parent[1:], kind="stable")]
        self.first = np.searchsorted(self.parent[self.children], np.arange(len(self.row) + 1))

    @classmethod
    def build(cls, points: np.ndarray) -> CoverTree:
        wide = points.astype(np.float64)
        row, own, parent, radius = [], [], [], []

        def far(a: int, rest: np.ndarray) -> np.ndarray:
            return np.sqrt(((wide[rest] - wide[a]) ** 2).sum(axis=1))

        everything = np.arange(1, len(points))
        todo = [(0, 1, -1, everything, far(0, everything))]
        while todo:
            centre, counts, above, rest, dist = todo.pop()
            node, reach = len(row), float(dist.max(initial=0.0))
            row.append(centre)
            own.append(counts)
            parent.append(above)
            radius.append(reach * (1 + 1e-9))
            if len(rest) <= LEAF or reach == 0:
                row.extend(rest.tolist())
                own.extend([1] * len(rest))
                parent.extend([node] * len(rest))
                radius.extend([0.0] * len(rest))
                continue
            near = dist <= reach / 2
            if near.any():
                todo.append((centre, 0, node, rest[near], dist[near]))
            rest, dist = rest[~near], dist[~near]
            while len(rest):
                pick = int(rest[dist.argmax()])
                away = far(pick, rest)
                near = away <= reach / 2
                mine = near & (rest != pick)
                todo.append((pick, 1, node, rest[mine], away[mine]))
                rest, dist = rest[~near], dist[~near]
        size = np.ones(len(row), np.int64)
        for i in range(len(row) - 1, 0, -1):
            size[parent[i]] += size[i]
        return cls(row=np.array(row, np.int32), own=np.array(own, np.int8), stop=(np.arange(len(row)) + size).astype(np.int32),
                   parent=np.array(parent, np.int32), radius=np.array(radius))

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: getattr(self, k) for k in self.FIELDS})
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> CoverTree:
        return cls(**np.load(io.BytesIO(data)))

    def assign(self, points: np.ndarray, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(nodes, stops, entries): ranges of nodes and the entry that all points in the range are nearest to; together they hold
        every node once."""
        at = points[self.row]
        open_nodes = np.zeros(min(1, len(self.row)), np.int64)
        while len(open_nodes):
            squares = ((at[open_nodes][:, None, :] - entries[None]) ** 2).sum(axis=2)
            best = squares.argmin(axis=1)
            lines = np.arange(len(best))
            to_best = np.sqrt(squares[lines, best].astype(np.float64))
            others = squares.astype(np.float64)
            others[lines, best] = np.inf
            reach = self.radius[open_nodes]
            sure = (reach == 0) | (to_best + 2 * reach < np.sqrt(others.min(axis=1)) * (1 - 1e-9))
            yield open_nodes, np.where(sure, self.stop[open_nodes], open_nodes + 1), best
            split = open_nodes[~sure]
            spans = self.first[split + 1] - self.first[split]
            offset = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
            open_nodes = self.children[np.repeat(self.first[split], spans) + offset]

    def sums(self, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many points each entry gets, and their sums."""
        own = self.own.astype(np.int64)
        running = np.zeros((len(own) + 1, points.shape[1]), points.dtype)
        running[1:] = np.cumsum(points[self.row] * own[:, None], axis=0)
        number = np.r_[0, np.cumsum(own)]
        count = np.zeros(len(entries), np.int64)
        total = np.zeros(entries.shape, points.dtype)
        for nodes, stops, best in self.assign(points, entries):
            for e in np.unique(best):
                mine = best == e
                count[e] += (number[stops[mine]] - number[nodes[mine]]).sum()
                total[e] += (running[stops[mine]] - running[nodes[mine]]).sum(axis=0)
        return count, total

    def nearest(self, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """The entry of every point."""
        label = np.zeros(len(self.row), np.int64)
        for nodes, stops, best in self.assign(points, entries):
            spans = stops - nodes
            offset = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
            label[np.repeat(nodes, spans) + offset] = np.repeat(best, spans)
        out = np.zeros(len(points), np.int64)
        out[self.row[self.own == 1]] = label[self.own == 1]
        return out


def _blocks(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """One row for each block: ids, labels, components and the packed trees of its parts."""
    dtype = np.float32 if "float" in rows.schema["vector"].dataType.simpleString() else np.float64
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        n = table.num_rows
        vector = table["vector"].combine_chunks()
        data = vector.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(n, width)
        whole = integers(data)
        trees = [CoverTree.build(p).pack() for p in np.split(whole, parts, axis=1)]
        ends = pa.array([0, n], pa.int32())
        wrap = lambda c: pa.ListArray.from_arrays(ends, table[c].combine_chunks())
        return pa.RecordBatch.from_arrays(
            [wrap("id"), wrap("label"), pa.array([data.tobytes()], pa.binary()), pa.array([trees], pa.list_(pa.binary()))],
            names=["ids", "labels", "data", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while n + batch.num_rows >= BLOCK_ROWS:
                yield block([*held, batch.slice(0, BLOCK_ROWS - n)])
                batch, held, n = batch.slice(BLOCK_ROWS - n), [], 0
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
        if n:
            yield block(held)

    return stage(rows.mapInArrow(run, f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, data binary, trees array<binary>"),
                 "blocks")


def codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
          entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) for every row with a usable vector.

    Rows are left out whose vector is NULL, empty or holds a NULL, NaN, infinite or larger component than ``LARGEST``, or whose
    length differs from that of the smallest usable id or is no multiple of ``parts``. The first entries are the vectors of the
    smallest ids (equal ids by vector, NULL ids last; repeated rows each count), fewer if there are fewer rows. ``error`` is the
    squared distance to the entries in units of 1 / 4096, at most the largest long. An empty table gives no rows; other columns
    are ignored.
    """
    spark = prepare(vectors.sparkSession)
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    vector = F.col(vector_col) if kind in ("float", "double") else F.col(vector_col).cast("array<double>")
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector")).where(
        F.col("vector").isNotNull() & (F.size("vector") > 0) & (F.size("vector") % parts == 0)).where(usable)
    first = [F.asc_nulls_last("id"), F.asc("vector")]
    smallest = rows.orderBy(*first).limit(1).select(F.size("vector")).first()
    if smallest is None:
        return rows.select(F.col("id").alias(id_col), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    width = smallest[0]
    rows = rows.where(F.size("vector") == width)
    seeds = integers(np.array([r[0] for r in rows.orderBy(*first).limit(entries).select("vector").collect()]))
    books = np.split(seeds.astype(object), parts, axis=1)  # whole numbers of any size; 16 x width of them
    blocks = _blocks(rows, width, parts)
    dtype = np.float32 if kind == "float" else np.float64
    id_kind, label_kind = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, list]]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch["data"][i].as_py(), dtype).reshape(-1, width)
                trees = [CoverTree.unpack(t.as_py()) for t in batch["trees"][i].values]
                yield i, batch, list(zip(trees, np.split(integers(data), parts, axis=1), strict=True))

    def exact(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        points = narrow(points, book)
        return points, book.astype(points.dtype)

    each = width // parts
    for _ in range(rounds):
        now = books

        def gather(batches: Iterator[pa.RecordBatch], now: list = now) -> Iterator[pa.RecordBatch]:
            count = np.zeros((parts, len(now[0])), np.int64)
            total = np.zeros((parts, len(now[0]), each), object)
            for _, _, block in opened(batches):
                for p, (tree, points) in enumerate(block):
                    n, s = tree.sums(*exact(points, now[p]))
                    count[p] += n
                    total[p] += s
            p, e = np.nonzero(count)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()), "n": pa.array(count[p, e], pa.int64()),
                "sums": pa.array([[str(x) for x in total[i, j]] for i, j in zip(p, e, strict=True)], pa.list_(pa.string()))})

        with arrow_rows(spark, BLOCKS):
            found = blocks.select("data", "trees").mapInArrow(gather, "part int, entry int, n long, sums array<string>").groupBy(
                "part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}")
                                                              for i in range(each)]).collect()
        books = [b.copy() for b in books]
        for r in found:
            books[r["part"]][r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(each)]

    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel()).encode()).hexdigest()
    last = books

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, batch, block in opened(batches):
            chosen, error = [], 0
            for p, (tree, points) in enumerate(block):
                points, book = exact(points, last[p])
                mine = tree.nearest(points, book)
                chosen.append(mine)
                error = error + ((points - book[mine]) ** 2).sum(axis=1).astype(object)
            digits = np.stack(chosen, axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch["ids"][i].values, batch["labels"][i].values,
                 pa.array([d.tobytes().hex() for d in digits], pa.string()),
                 pa.array([min(int(x), (1 << 63) - 1) for x in error], pa.int64())], names=["id", "label", "code", "error"])

    with arrow_rows(spark, BLOCKS):
        coded = stage(blocks.mapInArrow(finish, f"id {id_kind}, label {label_kind}, code string, error long"), "codes")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    sums = stage(coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(19,0)")).cast("decimal(38,0)"), most).cast(
        "long").alias("label_error")), "label_errors").withColumnRenamed("label", "of")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for the rows of ``codes`` over ``embeddings``."""
    steps = "".join(f"""
near{r} AS (
  SELECT vec_id, p, e, d FROM (
    SELECT x.vec_id, x.p, b.e, sum((x.v - b.v) * (x.v - b.v)) AS d FROM cells x JOIN book{r} b USING (p, j) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) = 1),
book{r + 1} AS (
  SELECT b.p, b.e, b.j, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN (
    SELECT p, e, j, (sum(v) - ((sum(v) % count(*) + count(*)) % count(*))) // count(*) AS v
    FROM cells JOIN near{r} USING (vec_id, p) GROUP BY p, e, j) m USING (p, e, j)),""" for r in range(rounds))
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding, len(embedding) // {parts} AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS (
  SELECT vec_id, (k - 1) // w AS p, (k - 1) % w AS j, floor(4096 * embedding[k]::DOUBLE)::BIGINT AS v
  FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS k FROM kept)),
book0 AS (
  SELECT p, e, j, v FROM cells JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}) USING (vec_id)),{steps}
last AS (
  SELECT vec_id, p, e, d FROM (
    SELECT x.vec_id, x.p, b.e, sum((x.v - b.v) * (x.v - b.v)) AS d FROM cells x JOIN book{rounds} b USING (p, j) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) = 1),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d) AS error
  FROM last JOIN kept USING (vec_id) GROUP BY vec_id, label)
SELECT vec_id, code, error::BIGINT AS error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, e, j)) FROM book{rounds}) AS codebooks_sha256 FROM coded"""
