"""Phrase collocations from external count streams in prefix and suffix order.

Counts are never gathered in a hash table of all phrases. Batches of text write sorted streams of what they hold; Spark sorts
the streams of all batches into ranges and each range is added up in one pass. Words come first, then pairs of frequent words,
then longer phrases of frequent pairs: a phrase cannot be more frequent than its parts, so what is left out cannot reach the
least count. The frequent phrases, sorted by their words (prefix order) and by their words from the last (suffix order), are
read in step with their own parts: in prefix order a phrase follows its first words, in suffix order its last ones.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketspark.llm.common import arrow_rows, groups_for, prepare, stage, text_or_empty

#: Bytes of text of a language that are counted together, and tokens in one stored row.
BATCH_BYTES, ROW_TOKENS = 16 << 20, 1 << 16
#: Rows of a stream that a worker reads at once, rows in one sorted range, and answers packed together before they are sent.
STREAM_ROWS, RANGE_ROWS, ANSWERS = 20_000, 1 << 19, 1 << 18
#: Rows in one range of the frequent phrases, and sampled rows for each such range.
PHRASE_ROWS, SAMPLE = 1 << 19, 64
#: Lower-cases A-Z, makes every end of a piece a line feed and every space between words a space.
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


def pieces_of(texts: Iterable[str]) -> tuple[list[bytes], list[int]]:
    """All words, and the number of words in each piece."""
    words, sizes = [], []
    for text in texts:
        for piece in text.encode("utf-8", "surrogatepass").translate(_BYTES).split(b"\n"):
            if found := piece.split():
                words += found
                sizes.append(len(found))
    return words, sizes


def _encode(docs: DataFrame) -> DataFrame:
    """Batches of one language: kind 0 rows (code, word, count), kind 1 rows of tokens (code + 1; 0 ends a piece)."""
    columns = ["kind", "batch", "lang", "code", "word", "count", "tokens"]

    def rows_of(batch: int, lang: str, texts: list[str]) -> Iterator[pd.DataFrame]:
        words, sizes = pieces_of(texts)
        if not words:
            return
        flat = np.empty(len(words), dtype=object)
        flat[:] = words
        codes, unique = pd.factorize(flat)
        count = np.bincount(codes, minlength=len(unique))
        yield pd.DataFrame({"kind": 0, "batch": batch, "lang": lang, "code": np.arange(len(unique)), "count": count, "tokens": None,
                            "word": [w.decode("utf-8", "surrogatepass") for w in unique]}, columns=columns)
        stream = np.insert((codes + 1).astype("<u4"), np.cumsum(sizes, dtype=np.int64), 0)
        packer = zstandard.ZstdCompressor(level=1)
        parts = [packer.compress(stream[i:i + ROW_TOKENS].tobytes()) for i in range(0, len(stream), ROW_TOKENS)]
        yield pd.DataFrame({"kind": 1, "batch": batch, "lang": lang, "code": np.arange(len(parts)), "word": None, "count": 0,
                            "tokens": parts}, columns=columns)

    def run(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[str]] = {}
        size, batch = 0, TaskContext.get().partitionId() << 24

        def flush() -> Iterator[pd.DataFrame]:
            nonlocal size, batch
            for lang, texts in held.items():
                yield from rows_of(batch, lang, texts)
                batch += 1
            held.clear()
            size = 0

        for chunk in chunks:
            for lang, text in zip(chunk["lang"], chunk["text"], strict=True):
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size >= BATCH_BYTES:
                    yield from flush()
        yield from flush()

    rows = docs.mapInPandas(run, "kind int, batch long, lang string, code long, word string, count long, tokens binary")
    return stage(rows, "batches", ("kind",))


def runs(chunks: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames of whole runs of equal keys from a sorted stream, with the row where each run starts."""

    def starts_of(frame: pd.DataFrame) -> np.ndarray:
        change = np.zeros(len(frame), bool)
        change[:1] = True
        for k in keys:
            v = frame[k].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(change)

    open_run: list[pd.DataFrame] = []
    for chunk in chunks:
        if not len(chunk):
            continue
        at = starts_of(chunk)
        if open_run and all(open_run[-1][k].iloc[-1] == chunk[k].iloc[0] for k in keys):
            if len(at) == 1:
                open_run.append(chunk)
                continue
        elif open_run:
            whole = pd.concat(open_run, ignore_index=True)
            yield whole, starts_of(whole)
            open_run = []
        if len(at) > 1:
            whole = pd.concat([*open_run, chunk.iloc[:at[-1]]], ignore_index=True)
            yield whole, starts_of(whole)
        open_run = [chunk.iloc[at[-1]:]]
    if open_run:
        whole = pd.concat(open_run, ignore_index=True)
        yield whole, starts_of(whole)


def _packed(held: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
    """One row for each batch: its answers as two runs of numbers."""
    batch, a, b = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(batch, kind="stable")
    batch, a, b = batch[order], a[order], b[order]
    at = np.flatnonzero(np.r_[True, batch[1:] != batch[:-1]])
    ends = np.r_[at[1:], len(batch)]
    return pd.DataFrame({"kind": 1, "batch": batch[at], "a": [a[i:j].tobytes() for i, j in zip(at, ends, strict=True)],
                         "b": [b[i:j].tobytes() for i, j in zip(at, ends, strict=True)]})


def _unpacked(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(b"".join(rows[c]), np.int64) for c in ("a", "b"))


def _frequent(rows: DataFrame, keys: list[str], least: int, numbered: bool) -> DataFrame:
    """Add up a count stream range by range. Kind 0: a row for each frequent key; kind 1: answers to the batches that hold it.

    An answer is the key's code in the batch and its new number, or the two words of a pair. A key's rows meet in one range, one
    row for each batch that holds it, whatever its count.
    """
    ranges = groups_for(rows.count(), RANGE_ROWS)
    columns = ["kind", *keys, "f", "id", "batch", "a", "b"]

    def run(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 40
        held, waiting = [], 0
        for frame, at in runs(chunks, keys):
            total = np.add.reduceat(frame["count"].to_numpy(), at)
            often = total >= least
            if not often.any():
                continue
            sizes = np.diff(np.r_[at, len(frame)])
            inside = np.repeat(often, sizes)
            batch = frame["batch"].to_numpy(np.int64)[inside]
            ids = number + np.arange(often.sum())
            number += len(ids)
            one = {k: frame[k].to_numpy()[at[often]] for k in keys}
            yield pd.DataFrame({"kind": 0, **one, "f": total[often], "id": ids, "batch": None, "a": None, "b": None})
            if numbered:
                held.append((batch, frame["code"].to_numpy(np.int64)[inside], np.repeat(ids, sizes[often])))
            else:
                held.append((batch, *(frame[k].to_numpy(np.int64)[inside] for k in keys)))
            waiting += len(batch)
            if waiting >= ANSWERS:
                yield _packed(held).assign(**dict.fromkeys([*keys, "f", "id"]))[columns]
                held, waiting = [], 0
        if held:
            yield _packed(held).assign(**dict.fromkeys([*keys, "f", "id"]))[columns]

    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    sorted_rows = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    with arrow_rows(rows.sparkSession, STREAM_ROWS):
        return stage(sorted_rows.mapInPandas(run, f"kind int, {kinds}, f long, id long, batch long, a binary, b binary"),
                     "frequent", ("kind",))


def _tokens(rows: pd.DataFrame, words: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent word ids of a batch in order, and for every token its place among them (-1: another word or the end of a piece)."""
    unpack = zstandard.ZstdDecompressor().decompress
    codes = np.concatenate([np.frombuffer(unpack(t), "<u4") for t in rows.sort_values("code")["tokens"]]).astype(np.int64)
    own, ids = _unpacked(words)
    order = np.argsort(ids)
    place = np.full(codes.max(initial=0) + 2, -1, np.int64)
    place[own[order] + 1] = np.arange(len(ids))
    return ids[order], place[codes]


def _pairs(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """(w1, w2, batch, count): pairs of frequent words that stand together, in prefix order within a batch."""

    def run(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(known):
            return pd.DataFrame(columns=["w1", "w2", "batch", "count"], dtype=np.int64)
        ids, at = _tokens(rows, known)
        both = (at[:-1] >= 0) & (at[1:] >= 0)
        pair, count = np.unique(at[:-1][both] * len(ids) + at[1:][both], return_counts=True)
        return pd.DataFrame({"w1": ids[pair // len(ids)], "w2": ids[pair % len(ids)], "batch": int(rows["batch"].iloc[0]), "count": count})

    both = tokens.groupBy("batch").cogroup(words.groupBy("batch")).applyInPandas(run, "w1 long, w2 long, batch long, count long")
    return stage(both, "pairs")


def _longer(tokens: DataFrame, answers: DataFrame, longest: int) -> DataFrame:
    """(w1 .. wn, count): at every place the longest phrase of 3 to n words whose pairs are all frequent; -1 fills the rest."""
    names = [f"w{i + 1}" for i in range(longest)]

    def run(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        pairs = known[known["pair"]]
        if not len(rows) or not len(pairs):
            return pd.DataFrame(columns=[*names, "count"], dtype=np.int64)
        ids, at = _tokens(rows, known[~known["pair"]])
        w1, w2 = (np.searchsorted(ids, w) for w in _unpacked(pairs))
        often = np.sort(w1 * len(ids) + w2)
        found = at[:-1] * len(ids) + at[1:]
        near = np.minimum(np.searchsorted(often, found), len(often) - 1)
        linked = (at[:-1] >= 0) & (at[1:] >= 0) & (often[near] == found)
        linked = np.r_[linked, np.zeros(longest, bool)]
        start = np.flatnonzero(linked[:-1] & linked[1:])
        grams = np.full((len(start), longest), -1, np.int64)
        grams[:, 0] = at[start]
        on = np.ones(len(start), bool)
        for i in range(1, longest):
            on &= linked[start + i - 1]
            grams[on, i] = at[start[on] + i]
        order = np.lexsort(grams.T[::-1])
        grams = grams[order]
        new = np.flatnonzero(np.r_[True, (grams[1:] != grams[:-1]).any(axis=1)][:len(grams)])
        count = np.diff(np.r_[new, len(grams)])
        out = np.where(grams[new] >= 0, ids[grams[new]], -1)
        return pd.DataFrame(out, columns=names).assign(count=count)

    schema = ", ".join(f"{c} long" for c in [*names, "count"])
    return stage(tokens.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(run, schema), "stream")


def _prefix_counts(rows: DataFrame, longest: int, least: int) -> DataFrame:
    """Counts of all phrases of 3 to n words from one stream in prefix order, where a phrase's extensions follow it.

    A run that touches the border of a range is written with what the range holds of it; the parts of such runs, at most a few
    for each border, are added up afterwards.
    """
    names = [f"w{i + 1}" for i in range(longest)]

    def run(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, sums, first = None, {}, set(range(3, longest + 1))  # the last row, open runs by length, lengths not yet begun
        for chunk in chunks:
            if not len(chunk):
                continue
            words, count = chunk[names].to_numpy(np.int64), chunk["count"].to_numpy(np.int64)
            differs = words[1:] != words[:-1]
            before = words[0] != last if last is not None else np.ones(longest, bool)
            change = np.logical_or.accumulate(np.vstack([before, differs]), axis=1)
            out = []
            for k in range(3, longest + 1):
                at = np.flatnonzero(np.r_[True, change[1:, k - 1]])
                total = np.add.reduceat(count, at)
                heads = words[at].copy()
                heads[:, k:] = -1
                if k in sums and not change[0, k - 1]:
                    total[0] += sums[k][1]
                elif k in sums:
                    heads, total = np.vstack([sums[k][0], heads]), np.r_[sums[k][1], total]
                sums[k] = heads[-1], total[-1]
                heads, total = heads[:-1], total[:-1]
                keep = total >= least
                if len(heads) and k in first:
                    keep[0] = True
                    first.discard(k)
                keep &= heads[:, k - 1] >= 0
                out.append(pd.DataFrame(heads[keep], columns=names).assign(f=total[keep]))
            last = words[-1]
            yield pd.concat(out, ignore_index=True)
        for k, (head, total) in sums.items():
            if head[k - 1] >= 0:
                yield pd.DataFrame([head], columns=names).assign(f=total)

    schema = ", ".join(f"{c} long" for c in [*names, "f"])
    ordered = rows.repartitionByRange(groups_for(rows.count(), RANGE_ROWS), *names).sortWithinPartitions(*names)
    with arrow_rows(rows.sparkSession, STREAM_ROWS):
        counted = stage(ordered.mapInPandas(run, schema), "runs")
    return counted.groupBy(*names).agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _in_step(grams: DataFrame, side: str, total: int) -> DataFrame:
    """(words, f, side, parts, same): every phrase with the counts of its shorter parts on one side, in one pass over its order.

    ``words`` run from the first word on (side "prefix") or from the last (side "suffix"); ``parts`` are the counts of the first
    1, 2, .. of them. ``same`` tells that one word more leaves the count as it is. Ranges of the order are cut at sampled phrases,
    and the shorter parts of a cut are copied to every range they reach into, so a range needs no other.
    """
    words = F.col("words") if side == "prefix" else F.reverse("words")
    rows = grams.select(words.alias("words"), "f")
    ranges = groups_for(total, PHRASE_ROWS)
    each = max(1, total // (SAMPLE * ranges))
    sample = [] if ranges == 1 else sorted(
        tuple(r[0]) for r in rows.where(F.pmod(F.xxhash64("words"), F.lit(each)) == 0).select("words").collect())
    cuts = [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []

    def deal(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            out = []
            for w, f in zip(chunk["words"], chunk["f"], strict=True):
                key = tuple(w.tolist())
                own = bisect_right(cuts, key)
                out += [(p, key, f, p == own) for p in range(own, bisect_right(cuts, (*key, float("inf"))) + 1)]
            yield pd.DataFrame(out, columns=["part", "words", "f", "own"])

    def run(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, stack = None, []  # the phrases whose extensions may still follow: [words, f, own, same]
        for chunk in chunks:
            out = []

            def leave(depth: int, out: list = out) -> None:
                while len(stack) > depth:
                    w, f, own, same = stack.pop()
                    if own or same:
                        out.append((w, f if own else None, [s[1] for s in stack] if own else None, same))

            for p, w, f, own in zip(chunk["part"], chunk["words"], chunk["f"], chunk["own"], strict=True):
                key = w.tolist()
                depth = len(key) - 1
                if p != part:
                    leave(0)
                    part = p
                leave(depth)
                if stack and stack[-1][1] == f:
                    stack[-1][3] = True
                stack.append([key, f, own, False])
            yield pd.DataFrame(out, columns=["words", "f", "parts", "same"])
        out = []
        leave(0, out) if part is not None else None
        yield pd.DataFrame(out, columns=["words", "f", "parts", "same"])

    with arrow_rows(grams.sparkSession, STREAM_ROWS):
        dealt = rows.mapInPandas(deal, "part int, words array<long>, f long, own boolean")
        ordered = dealt.repartition(ranges, "part").sortWithinPartitions("part", "words")
        found = stage(ordered.mapInPandas(run, "words array<long>, f long, parts array<long>, same boolean"), side)
    return found.select((F.col("words") if side == "prefix" else F.reverse("words")).alias("words"), "f",
                        F.lit(side).alias("side"), "parts", "same")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, longest: int = 5,
                 top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to ``longest`` words of every language.

    A phrase counts if it stands ``least`` times inside pieces of the language's texts. ``a`` is its count, ``l`` and ``r`` those
    of its two parts at the cut with the lowest score floor(1000 a n / (l r)), ``n`` all words of the language. Phrases that are
    part of a longer one with the same count are left out. NULL text counts as empty; NULL language is "und". Repeated rows count
    each time. Equal scores are ordered by count, then phrase. An empty table gives no rows; other columns are ignored.
    """
    if longest < 3:
        raise ValueError("phrases of 3 words at least")
    prepare(docs.sparkSession)
    slim = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text_col).alias("text"))
    batches = _encode(slim)
    tokens = batches.where("kind = 1").select("batch", "code", "tokens")
    vocabulary = batches.where("kind = 0").select("lang", "word", "batch", "code", "count")
    sizes = vocabulary.groupBy("lang").agg(F.sum("count").alias("n"))

    words = _frequent(vocabulary, ["lang", "word"], least, numbered=True)
    answers = lambda found, pair: found.where("kind = 1").select("batch", "a", "b", F.lit(pair).alias("pair"))
    pairs = _frequent(_pairs(tokens, answers(words, False)), ["w1", "w2"], least, numbered=False)
    longer = _prefix_counts(_longer(tokens, answers(words, False).union(answers(pairs, True)), longest), longest, least)

    word = words.where("kind = 0").select("id", "lang", "word", "f")
    grams = stage(word.select(F.array("id").alias("words"), "f").union(
        pairs.where("kind = 0").select(F.array("w1", "w2"), "f")).union(
        longer.select(F.filter(F.array(*[f"w{i + 1}" for i in range(longest)]), lambda w: w >= 0), "f")), "phrases")
    total = grams.count()
    sides = _in_step(grams, "prefix", total).union(_in_step(grams, "suffix", total))
    on = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    counted = sides.groupBy("words").agg(F.max("f").alias("a"), on("prefix", "parts").alias("left"), on("suffix", "parts").alias("right"),
                                         F.max("same").alias("same")).where("size(words) > 1 AND NOT same")

    placed = counted.select("*", F.posexplode("words").alias("place", "id")).join(word.select("id", "lang", "word"), "id")
    spelled = placed.groupBy("words").agg(
        F.first("a").alias("a"), F.first("left").alias("left"), F.first("right").alias("right"), F.first("lang").alias("lang"),
        F.array_join(F.array_sort(F.collect_list(F.struct("place", "word"))).word, " ").alias("phrase"))
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    amount = (whole("a") * F.lit(1000) * whole("n")).cast("decimal(38,0)")
    cut = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda k: F.struct(
        F.call_function("div", F.col("amount"), (F.get("left", k - 1).cast("decimal(19,0)") * F.get(
            "right", F.size("words") - k - 1).cast("decimal(19,0)")).cast("decimal(38,0)")).alias("score"),
        k.alias("k"), F.get("left", k - 1).alias("l"), F.get("right", F.size("words") - k - 1).alias("r")))
    scored = spelled.join(sizes, "lang").withColumn("amount", amount).withColumn("cut", F.array_min(cut)).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = 100, longest: int = 5, top: int = 2000) -> str:
    """DuckDB SQL for the rows of ``collocations`` over ``documents``."""
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM pieces),
spans AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM lists, range(1, {longest} + 1) AS ks(k)),
total AS (SELECT lang, sum(len(ws)) AS n FROM lists GROUP BY lang),
grams AS (
  SELECT lang, k, list_aggregate(ws[i:i + k - 1], 'string_agg', ' ') AS phrase, count(*) AS f
  FROM spans GROUP BY lang, k, phrase HAVING count(*) >= {least}),
parts AS (SELECT *, string_split(phrase, ' ') AS ws FROM grams WHERE k > 1),
inside AS (
  SELECT lang, list_aggregate(ws[1:k - 1], 'string_agg', ' ') AS phrase, f FROM parts
  UNION SELECT lang, list_aggregate(ws[2:k], 'string_agg', ' '), f FROM parts),
free AS (SELECT * FROM parts ANTI JOIN inside USING (lang, phrase, f)),
cuts AS (
  SELECT lang, k, phrase, f, unnest(range(1, k)) AS c, ws FROM free),
valued AS (
  SELECT c.lang, c.phrase, c.f AS a, c.c, l.f AS l, r.f AS r, t.n,
    (1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN total t USING (lang)
  JOIN grams l ON l.lang = c.lang AND l.phrase = list_aggregate(c.ws[1:c.c], 'string_agg', ' ')
  JOIN grams r ON r.lang = c.lang AND r.phrase = list_aggregate(c.ws[c.c + 1:c.k], 'string_agg', ' ')),
least AS (
  SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= {top}"""
