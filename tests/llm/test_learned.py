"""Collocations, vector codes and toxicity against brute force and held-out labels; edge cases of each."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import check_queries
from marketspark.llm import codes, phrases, toxicity

EXTRA = ("id", "words", "f", "part", "batch", "vector", "member", "key", "count", "rank", "of", "held_out", "score")


@pytest.mark.parametrize("name", ["op11_phrase_collocations", "op12_vector_codes"])
def test_against_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    ok, message, _ = check_queries.compare(spark, check_queries.connect(sf), name, sf)
    assert ok, message


def collocations_slowly(rows, least, longest=5, top=2000):
    """Straight from the definition, with Python numbers; the containment rule is applied to all longer candidates."""
    found, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", small):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    found[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in found.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in often.items():
            inside = lambda q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731,B023
            if any(len(q) > len(p) and inside(q) and 100 * b >= 100 * a for q, b in often.items()):
                continue
            cuts = [(1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, phrase, left, right) in enumerate(sorted(ranked)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def phrase_rows(spark, rows):
    ddl = "lang string, text string, " + ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in rows], ddl)


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_by_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(phrases, "BATCH_BYTES", 3000)  # many batches, ranges and pieces of streams
    monkeypatch.setattr(phrases, "ROW_TOKENS", 50)
    monkeypatch.setattr(phrases, "RANGE_ROWS", 100)
    monkeypatch.setattr(phrases, "PHRASE_ROWS", 40)
    monkeypatch.setattr(phrases, "STREAM_ROWS", 7)
    draw = random.Random(seed)
    words = ["the", "The", "of", "a\x01b", "é", "É", "new", "york", "x\xa0y", "état", "ß", "10", " ", "z" * 50]
    rows = []
    for _ in range(300):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "!", "?", ";", ":", "\x0b"])
                       for _ in range(draw.randrange(40)))
        rows.append((draw.choice(["en", "en", "en", None, "und", "fr"]), text + "new york is a big city in the state of mind"))
    rows += [("en", None), (None, ""), ("en", " . , \n"), ("xx", "only once")] + rows[:20]
    for least in (3, 40):
        got = phrases.collocations(phrase_rows(spark, rows).repartition(5), least=least, top=150)
        assert sorted(tuple(r) for r in got.collect()) == collocations_slowly(rows, least, top=150)


def test_collocations_edges(spark):
    assert phrases.collocations(phrase_rows(spark, []), least=2).count() == 0
    assert phrases.collocations(phrase_rows(spark, [("en", None), (None, "a b")]), least=2).count() == 0
    long = [("en", "pim pam pum " * 60_000)]
    got = [tuple(r) for r in phrases.collocations(phrase_rows(spark, long)).collect()]
    assert sorted(got) == collocations_slowly(long, 100)


def codes_slowly(rows, parts=8, entries=16, rounds=6):
    """All distances of all points to all entries, with Python numbers."""
    kept = [(i, lab, [math.floor(4096 * x) for x in v]) for i, lab, v in rows
            if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) and abs(x) < codes.LARGEST for x in v)]
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    if not kept:
        return []
    width = len(min(kept, key=order)[2])
    kept = [r for r in kept if len(r[2]) == width]
    w = width // parts
    cut = lambda v, p: v[p * w:(p + 1) * w]
    first = sorted(kept, key=order)[:entries]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]

    def nearest(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            held = collections.defaultdict(list)
            for _, _, v in kept:
                held[nearest(cut(v, p), book)[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(held[k]) for c in zip(*held[k], strict=True)] if k in held else e for k, e in enumerate(book)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = []
    for i, lab, v in kept:
        found = [nearest(cut(v, p), b) for p, b in enumerate(books)]
        coded.append((i, lab, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    total = collections.Counter()
    for _, lab, _, e in coded:
        total[lab] += e
    return sorted([(i, c, e, total[lab], digest) for i, lab, c, e in coded], key=repr)


def vector_rows(spark, rows, kind="float"):
    ddl = f"vec_id long, label int, embedding array<{kind}>, " + ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in rows], ddl)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_codes_by_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(codes, "BLOCK_ROWS", 50)
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(9, 16))
    spread = [0.01, 0.3]
    rows = [(int(i), int(draw.integers(4)), [float(np.float32(x)) for x in centres[draw.integers(9)] + draw.normal(size=16) * spread[i % 2]])
            for i in draw.permutation(300)]
    rows += [(i, None, rows[0][2]) for i in range(1000, 1150)]  # a very common vector
    rows += [(7, 1, rows[3][2]), (7, 1, rows[3][2]), (None, 2, rows[5][2]), ((1 << 60) + 1, 2, rows[6][2])]
    rows += [(2000, 1, None), (2001, 1, [None] * 16), (2002, 1, [float("nan")] * 16), (2003, 1, [float("inf")] + [0.0] * 15),
             (2004, 1, []), (2005, 1, [0.0] * 8), (2006, 1, [0.0] * 15), (2007, 3, [0.0] * 16), (-1, 3, [1e30] * 16)]
    got = codes.codes(vector_rows(spark, rows, kind).repartition(3))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == codes_slowly(rows)


def test_codes_with_very_large_components(spark):
    draw = random.Random(3)
    rows = [(i, i % 2, [draw.uniform(-1, 1) * 10.0 ** draw.randrange(12) for _ in range(8)]) for i in range(60)]
    got = [tuple(r) for r in codes.codes(vector_rows(spark, rows, "double")).collect()]
    want = [(i, c, min(e, (1 << 63) - 1), min(t, (1 << 63) - 1), d) for i, c, e, t, d in codes_slowly(rows)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_codes_edges(spark):
    assert codes.codes(vector_rows(spark, [])).collect() == []
    assert codes.codes(vector_rows(spark, [(1, 1, None)])).collect() == []
    few = [(1, 1, [0.5] * 8), (2, None, [0.25] * 8), (2, None, [0.25] * 8)]
    assert sorted((tuple(r) for r in codes.codes(vector_rows(spark, few)).collect()), key=repr) == codes_slowly(few)


def test_cover_tree_covers(spark):
    points = np.random.default_rng(1).integers(-3000, 3000, (700, 8))
    points[100:200] = points[5]
    tree = codes.CoverTree.unpack(codes.CoverTree.build(points).pack())
    assert sorted(tree.row[tree.own == 1].tolist()) == list(range(700))
    for node in range(len(tree.row)):
        below = points[tree.row[node:tree.stop[node]]] - points[tree.row[node]]
        assert np.sqrt((below ** 2).sum(axis=1)).max() <= tree.radius[node]
        assert (tree.parent[node + 1:tree.stop[node]] >= node).all()


def test_cover_tree_skips_points():
    draw = np.random.default_rng(2)
    centres = draw.integers(-40_000, 40_000, (16, 8))
    points = centres[draw.integers(16, size=4000)] + draw.integers(-200, 200, (4000, 8))
    tree = codes.CoverTree.build(points)
    compared = sum(len(nodes) for nodes, _, _ in tree.assign(points, centres))
    assert compared < 400  # of 4,000 points: whole subtrees went at once


def held_out(i):
    return zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 0


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in entry.queries()["op13_toxicity"](spark, sf).collect()}
    con = duckdb.connect()
    ids = [r[0] for r in con.execute(f"SELECT doc_id FROM '{sf}/documents.parquet'").fetchall()]
    assert sorted(rows) == sorted(ids) and all(r["held_out"] == held_out(i) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())
    labels = [(i, t) for i, t in con.execute(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall() if i in rows and held_out(i)]
    toxic = [rows[i]["predicted"] for i, t in labels if t]
    clean = [rows[i]["predicted"] for i, t in labels if not t]
    assert len(toxic) > 50 and np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.03


def toxic_tables(spark, docs, labels):
    ddl = "doc_id long, text string, " + ", ".join(f"{c} string" for c in EXTRA)
    return (spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in docs], ddl),
            spark.createDataFrame([(*r, 1, "x") for r in labels], "doc_id long, toxic int, quality int, text string"))


def test_toxicity_edges(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    docs = [(i, " ".join(word() for _ in range(30)) + (" Zounds, knave!" if i % 4 == 0 else "")) for i in range(400)]
    labels = [(i, int(i % 4 == 0)) for i in range(300)] + [(None, 1), (3, None), (5, 0), (5, None)]
    odd = [(None, "zounds knave"), (1000, None), (1001, ""), (1002, "zounds knave " + "plain words here " * 40_000), (1003, "???")]
    odd += [docs[8], docs[8]]
    got = [(r["doc_id"], r["predicted"], r["score"], r["held_out"]) for r in toxicity.toxicity(
        *toxic_tables(spark, docs + odd, labels)).collect()]
    assert len(got) == len(docs) + len(odd)
    marks = {i: p for i, p, _, _ in got}
    assert np.mean([marks[i] == (i % 4 == 0) for i in range(300, 400)]) >= 0.98
    assert marks[None] == 1 and marks[1000] == marks[1001] == marks[1003] == 0 and marks[1002] == 1
    assert [h for i, _, _, h in got if i is None] == [True]
    assert sum(i == 8 for i, *_ in got) == 3
    assert toxicity.toxicity(*toxic_tables(spark, [], labels)).count() == 0
    none = toxicity.toxicity(*toxic_tables(spark, docs[:5], [])).collect()
    assert {r["score"] for r in none} == {0.0}
    clean = toxicity.toxicity(*toxic_tables(spark, docs[:5], [(i, 0) for i in range(5)])).collect()
    assert {r["predicted"] for r in clean} == {0}
    assert toxicity.toxicity(*toxic_tables(spark, docs[:9], [(i, 1) for i in range(9)])).count() == 9


def test_toxicity_learns_no_held_out_label(spark):
    docs = [(i, f"alpha beta {'gamma' if held_out(i) else 'delta'}") for i in range(200)]
    one = [(i, int(held_out(i))) for i in range(200)]
    two = [(i, 1 - int(held_out(i)) if held_out(i) else 0) for i in range(200)]
    first, second = ({r["doc_id"]: r["score"] for r in toxicity.toxicity(*toxic_tables(spark, docs, x)).collect()} for x in (one, two))
    assert first == second
