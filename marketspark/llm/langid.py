"""Language of documents: text likelihood, declared language, address suffix and host prior fused by Bayes' rule."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import prepare, stage, text_or_empty

#: Hash buckets of the byte trigrams.
BUCKETS = 1 << 16
#: Documents per language that the text model is fitted on, about (a bounded sample of labelled rows).
SAMPLE = 500
#: Languages whose likelihoods a task holds at once (64 MB). Every declared language is told apart, in as many blocks as it takes.
BLOCK = 256
#: Overlapping trigrams repeat each other's evidence; their log-likelihood counts by this weight.
TEMPER = 0.3
#: Strength of the parent (domain, then all hosts) in the smoothed host priors, in documents.
PRIOR = 20.0
#: Trigrams below which a text alone casts no vote in the counts, and is never called foreign.
SHORT = 20
#: Share of the way from usual text to random bytes beyond which a text is noise. Short texts with names, keys or two
#: languages are far from usual and still text.
NOISE = 0.85
UNKNOWN = "und"
#: Bytes of text scored at once in a task.
CHUNK = 4 << 20

_PLAIN = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash buckets of the letter trigrams of all texts, how many each text has)."""
    cleaned = [b" " + b" ".join(t.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split()) + b" "
               for t in texts]
    sizes = np.array([len(c) - 2 if len(c) > 2 else 0 for c in cleaned], dtype=np.int64)
    data = np.frombuffer(b"".join(c for c, n in zip(cleaned, sizes, strict=True) if n), dtype=np.uint8).astype(np.uint32)
    if not len(data):
        return np.zeros(0, dtype=np.int64), sizes
    codes = (data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA77) + data[2:] * np.uint32(0xC2B2AE3D))
    codes = np.r_[codes >> np.uint32(16), np.zeros(2, dtype=np.uint32)]
    # The two trigrams that cross into the next text go.
    keep = np.ones(len(data), dtype=bool)
    stops = np.cumsum(sizes[sizes > 0] + 2)
    keep[stops - 1] = keep[stops - 2] = False
    return codes[keep].astype(np.int64), sizes


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for hi in range(1, len(texts) + 1):
        held += len(texts[hi - 1])
        if held >= CHUNK or hi == len(texts):
            yield lo, hi
            lo, held = hi, 0


def base_language(column: str) -> Column:
    """"EN-us" and "en_US" as "en"; empty as NULL."""
    short = F.lower(F.regexp_extract(F.trim(F.col(column).cast("string")), r"^([A-Za-z]+)", 1))
    return F.when(short != "", short)


def host_name(column: str) -> Column:
    """The host of an address, or the value itself if it is not one."""
    raw = F.coalesce(F.col(column).cast("string"), F.lit(""))
    found = F.regexp_extract(raw, r"^\w+://([^/:?#]+)", 1)
    return F.lower(F.when(found != "", found).otherwise(raw))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> tuple[list[str], Iterator[np.ndarray]]:
    """(languages, log-likelihood tables [bucket, language] of ``BLOCK`` languages each) from (id, text, declared).

    Rows are taken by the hash of their id, about ``sample`` of each language; the counts of a task are one row a language.
    """
    named = labelled.where("declared IS NOT NULL").groupBy("declared").count()
    kept = {r[0]: r[1] for r in named.orderBy("declared").collect()}
    names = list(kept)
    if not names:
        return [], iter(())
    # Languages of up to ``sample`` rows give all of them.
    rates = labelled.sparkSession.createDataFrame(
        [(k, i // BLOCK, sample / n) for i, (k, n) in enumerate(kept.items())], "declared string, block int, rate double")
    unit = F.pmod(F.xxhash64("id", F.octet_length("text")), F.lit(1 << 20)) / float(1 << 20)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, str], np.ndarray] = {}

        def held() -> pd.DataFrame:
            return pd.DataFrame([(*k, v.astype("<f4").tobytes()) for k, v in total.items()], columns=["block", "name", "counts"])

        for part in parts:
            for key, rows in part.groupby(["block", "declared"]):
                codes, _ = trigrams(rows["text"].tolist())
                total[key] = total.get(key, 0) + np.bincount(codes, minlength=BUCKETS)
                if len(total) >= BLOCK:
                    yield held()
                    total.clear()
        yield held()

    picked = labelled.join(F.broadcast(rates), "declared").where(unit < F.col("rate")).select("block", "declared", "text").coalesce(16)
    counted = stage(picked.mapInPandas(count, "block int, name string, counts binary"), "trigrams")

    def tables() -> Iterator[np.ndarray]:
        for lo in range(0, len(names), BLOCK):
            number = {n: i for i, n in enumerate(names[lo:lo + BLOCK])}
            table = np.zeros((BUCKETS, len(number)))
            for name, data in counted.where(F.col("block") == lo // BLOCK).select("name", "counts").toLocalIterator():
                table[:, number[name]] += np.frombuffer(data, "<f4")
            table += 0.1
            yield np.log(table / table.sum(axis=0)).astype(np.float32)

    return names, tables()


def text_scores(slim: DataFrame, shared: list, size: int) -> DataFrame:
    """The columns of ``slim`` but text, with n (trigrams) and loglik (one sum for each of ``size`` languages).

    ``shared`` are the broadcast tables; of several, a task holds one at a time.
    """
    fields = [f for f in slim.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n long, loglik array<double>"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts, sums, sizes = part["text"].tolist(), [], []
            for lo, hi in _chunks(texts):
                codes, n = trigrams(texts[lo:hi])
                whole, first = np.zeros((hi - lo, size)), 0
                starts = (np.cumsum(n) - n)[n > 0]
                for block in shared if len(codes) else ():
                    model = block.value
                    for k in range(model.shape[1]):
                        whole[n > 0, first + k] = np.add.reduceat(model[:, k].astype(np.float64)[codes], starts)
                    first += model.shape[1]
                    if len(shared) > 1:
                        del model
                        vars(block).pop("_value", None)  # read again from its file when next needed
                sums += whole.tolist()
                sizes += n.tolist()
            yield part.drop(columns="text").assign(n=sizes, loglik=sums)

    return slim.mapInPandas(run, schema)


def _counts(votes: DataFrame, key: str, size: int, out: str) -> DataFrame:
    """(key, out): votes per language as an array; partial sums before the shuffle, whatever the size of a key."""
    each = votes.where(F.col("vote") >= 0).groupBy(key, "vote").count()
    found = each.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("vote", "count"))).alias("found"))
    zero = F.lit(0).cast("long")
    return found.select(key, F.transform(F.sequence(F.lit(0), F.lit(size - 1)),
                                         lambda i: F.coalesce(F.try_element_at("found", i), zero)).alias(out))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str | None = "lang",
             host_col: str | None = "source", sample: int = SAMPLE) -> DataFrame:
    """(id_col, language, confidence, text_language, declared, trigrams): one row per input row.

    log P(l | all) = TEMPER * log P(text | l) + log P(l | host) + log P(declared | l) + log P(suffix | l) + constant.
    The text model is fitted on about ``sample`` rows per declared language, however rare it is. The other parts are grouped counts over all
    rows, each row voting for the language of its text: how often each language is declared as what, how often it occurs
    under each suffix, and how often on the host, smoothed by its domain, smoothed by all hosts. A row's own vote is taken out of
    its host's counts.

    ``language`` is "und" for texts without a letter and for texts of ``SHORT`` or more trigrams that fit the best language so
    badly that they are closer to random bytes (``NOISE`` of the way there) than to its usual text. NULL or empty text is "und". A NULL or unknown declared
    language, host or suffix is no evidence. Without any labelled row everything is "und". Repeated rows each get a row; an
    empty table gives none; other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    none = F.lit(None).cast("string")
    slim = docs.select(
        F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"),
        (base_language(declared_col) if declared_col else none).alias("declared"),
        (host_name(host_col) if host_col else F.lit("")).alias("host"))
    names, tables = fit(slim, sample)
    if not names:
        return slim.select(F.col("id").alias(id_col), F.lit(UNKNOWN).alias("language"), F.lit(0.0).alias("confidence"),
                           F.lit(UNKNOWN).alias("text_language"), "declared", F.lit(0).cast("long").alias("trigrams"))
    # Most of the way from the mean log-likelihood of a language's own trigrams to that of random ones.
    shared, usual = [], []
    for table in tables:
        usual.append((np.exp(table.astype(np.float64)) * table).sum(axis=0))
        shared.append(spark.sparkContext.broadcast(table))
        del table
    usual = np.concatenate(usual)
    floors = F.array(*[F.lit(float(x)) for x in usual + NOISE * (-np.log(BUCKETS) - usual)])
    labels = F.array(*[F.lit(n) for n in names])
    size = len(names)

    best = F.expr("array_position(loglik, array_max(loglik)) - 1").cast("int")
    fits = (F.col("n") > 0) & ((F.col("n") < SHORT) | (F.array_max("loglik") / F.col("n") >= F.get(floors, best)))
    parts = F.split("host", r"\.")
    scored = text_scores(slim, shared, size).select(
        "id", "declared", "host", "n", "loglik", best.alias("best"), fits.alias("fits"),
        F.when(fits & (F.col("n") >= SHORT), best).otherwise(-1).alias("vote"),
        F.when(F.size(parts) > 1, F.array_join(F.slice(parts, -2, 2), ".")).otherwise(F.col("host")).alias("domain"),
        F.when(F.size(parts) > 1, F.element_at(parts, -1)).alias("suffix"))
    scored = stage(scored, "scored")
    hosts = _counts(scored, "host", size, "on_host")
    domains = _counts(scored, "domain", size, "on_domain")
    votes = dict(scored.where("vote >= 0").groupBy("vote").count().collect())  # one row a language
    total = [votes.get(i, 0) for i in range(size)]
    world = F.array(*[F.lit((t + 1.0) / (sum(total) + size)) for t in total])

    def likelihoods(key: str, out: str) -> DataFrame:
        """(key, out): log P(key | language), one vote added for each language and value."""
        counted = _counts(scored.where(F.col(key).isNotNull()), key, size, "c")
        totals = F.array(*[F.lit(float(t)) for t in total])
        return counted.select(key, F.zip_with("c", totals, lambda c, t: F.log((c + 1.0) / (t + size))).alias(out))

    zero = F.array(*[F.lit(0.0)] * size)
    none_yet = F.array(*[F.lit(0).cast("long")] * size)

    def smoothed(counts: Column, parent: Column) -> Column:
        n = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
        return F.zip_with(counts, parent, lambda c, p: (c + PRIOR * p) / (n + PRIOR))

    rows = scored.join(hosts, "host", "left").join(domains, "domain", "left").join(
        likelihoods("declared", "by_declared"), "declared", "left").join(
        likelihoods("suffix", "by_suffix"), "suffix", "left")
    without = lambda c: F.transform(F.coalesce(F.col(c), none_yet), lambda x, i: x - (i == F.col("vote")).cast("long"))
    prior = smoothed(without("on_host"), smoothed(without("on_domain"), world))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    logp = add(add(F.transform("loglik", lambda x: x * TEMPER), F.transform(prior, lambda p: F.log(p))),
               add(F.coalesce("by_declared", zero), F.coalesce("by_suffix", zero)))
    rows = rows.select("id", "declared", "n", "best", "fits", logp.alias("p")).withColumn("top", F.array_max("p"))
    share = 1.0 / F.aggregate("p", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    winner = F.get(labels, F.expr("array_position(p, top) - 1").cast("int"))
    return rows.select(
        F.col("id").alias(id_col),
        F.when(F.col("fits"), winner).otherwise(UNKNOWN).alias("language"),
        F.when(F.col("fits"), F.round(share, 6)).otherwise(0.0).alias("confidence"),
        F.when(F.col("fits"), F.get(labels, F.col("best"))).otherwise(UNKNOWN).alias("text_language"),
        "declared", F.col("n").alias("trigrams"))
