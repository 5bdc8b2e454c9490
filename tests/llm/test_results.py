"""The registered text queries against brute force, round trips or held-out accuracy on the smallest tables."""

import collections
import html as stdhtml
import math
import random
import re
import zlib
from bisect import bisect_left, insort

import duckdb
import numpy as np
import pytest
import xxhash
from test_advice import groups

import __spark_entry__ as entry
import check_queries
import corpus_pipeline
from marketspark.llm import chat, decontaminate, html, langid, lm, packing, pii, search, simhash

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def small(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r[0]: r[1] or "" for r in rows}


def run(spark, name):
    return entry.queries()[name](spark, SF).collect()


def test_all_text_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))


@pytest.mark.parametrize("name", ["op3_quotation_linking", "op4_extendible_sharding"])
def test_against_sql(spark, name):
    ok, message, _ = check_queries.compare(spark, check_queries.connect(SF), name, SF)
    assert ok, message


def test_simhash(spark, texts):
    def slow(text):
        words = WORD.findall(small(text))
        if not words:
            return 0
        grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))

    prints = {i: slow(t) for i, t in texts.items()}
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if label[a] < label[b] and (prints[a] ^ prints[b]).bit_count() <= 4:
                    label[b], changed = label[a], True
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in run(spark, "op10_simhash_near_dedup")}
    assert got == {i: (f"{p:016x}", label[i]) for i, p in prints.items()}


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_links_of_random_fingerprints(spark, blocks, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 40)  # hot buckets are cut into chunks
    monkeypatch.setattr(simhash, "CELL", 500)
    rng = random.Random(blocks)
    centre = rng.getrandbits(64)
    values = {rng.getrandbits(64) for _ in range(150)}
    for _ in range(250):
        v = centre
        for b in rng.sample(range(64), rng.randint(0, 5)):
            v ^= 1 << b
        values.add(v)
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, blocks).collect()

    def groups(pairs):
        up = {v: v for v in signed}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in pairs:
            up[root(a)] = root(b)
        out = collections.defaultdict(set)
        for v in signed:
            out[root(v)].add(v)
        return {frozenset(g) for g in out.values()}

    mask = (1 << 64) - 1
    close = [(a, b) for a in signed for b in signed if ((a ^ b) & mask).bit_count() <= 4]
    assert groups([(r[0], r[1]) for r in found]) == groups(close)
    assert len(found) < len(close)


def best_fit(lengths, capacity):
    sizes, bins = [], 0
    for n in sorted(lengths, reverse=True):
        k = bisect_left(sizes, n)
        gap = sizes.pop(k) if k < len(sizes) else capacity
        bins += gap == capacity
        if gap > n:
            insort(sizes, gap - n)
    return bins


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.default_tokenizer())
    got = run(spark, "op2_best_fit_packing")
    by = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got}
    want = {}
    for i, t in texts.items():
        ids = [*coder.encode(t, add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k:k + 4096], dtype="<u4")
            want[i, k // 4096] = (k, len(part), zlib.crc32(part.tobytes()))
    assert by == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in bins.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(bins) == best_fit([r["length"] for r in got], 4096)


@pytest.mark.parametrize("seed", range(6))
def test_sweep_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, [100, 30, 60, 7, 100, 50][seed]) for _ in range(400)]
    lengths += [40] * 100
    bins, gaps, placed = 0, [], []
    for low, high in ((50, 100), (20, 50), (0, 20)):
        runs = collections.Counter(n for n in lengths if low < n <= high)
        new, gaps, bins = packing.sweep(list(runs.items()), gaps, bins, 100)
        placed += new
    assert bins == best_fit(lengths, 100)
    used = collections.defaultdict(list)
    for length, rank, n, each, first, offset in placed:
        for k in range(n):
            used[first + k // each].append((offset + k % each * length, length))
    assert sorted(x[1] for v in used.values() for x in v) == sorted(lengths)
    for v in used.values():
        end = 0
        for at, length in sorted(v):
            assert at == end
            end += length
        assert end <= 100


def test_word_ids_equal_the_tokenizer(texts):
    from tokenizers import Tokenizer

    from marketspark.llm.tokens import WordBpe

    path = packing.default_tokenizer()
    coder, plain = WordBpe(path), Tokenizer.from_file(path)
    odd = ["it's THE dog's we'll don't", "a²b ½ İstanbul ΟΔΟΣ naïve é x y z", "<|endoftext|> <|startoftext|>x", "",
           "\x1c\x85 tab\tnew\nline __init__ a_b 12 345", "日本語 テスト 😀!!", "''s 's's can''t", "ÀÉÎ.!!%%% ß ŉ ª º µ"]
    sample = odd + [t for _, t in sorted(texts.items())[:60]]
    for _ in range(2):  # the second time from the caches
        assert [np.frombuffer(b, "<u4").tolist() for b in coder.encode(sample)] == [
            plain.encode(t, add_special_tokens=False).ids for t in sample]


def test_lm(spark, texts):
    tokens = {i: [*WORD.findall(small(t)), "\n"] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    one, two = collections.Counter(), collections.Counter()
    for i, t in tokens.items():
        if not held[i]:
            one.update(t)
            two.update(zip(["\n", *t], t, strict=False))
    n, v, k = sum(one.values()), len(one), lm.BACKOFF
    unknown = max(1, sum(c == 1 for c in one.values())) / (n + 1)
    p = lambda w: (1 - unknown) * one[w] / n if one[w] else unknown
    rows = run(spark, "op9_lm_scoring")
    assert len(rows) == len(texts)
    for r in rows:
        t = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held[r["doc_id"]], len(t), sum(one[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t))
        assert r["score"] == pytest.approx(sum(
            math.log10((two[a, w] + k * p(w)) / (one[a] + k)) for a, w in zip(["\n", *t], t, strict=False)))
    # A distribution: the words and the one unknown sum to one after any word.
    after = tokens[next(iter(tokens))][0]
    assert sum((two[after, w] + k * p(w)) / (one[after] + k) for w in one) + k * unknown / (one[after] + k) == pytest.approx(1)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_search(spark, texts):
    words = {i: collections.Counter(re.findall(r"[^\W_]+", t.lower())) for i, t in texts.items()}
    length = {i: sum(c.values()) for i, c in words.items()}
    df = collections.Counter(w for c in words.values() for w in c)
    n, average = len(texts), sum(length.values()) / len(texts)
    want = {}
    for q in texts:
        if q % 100 == 0:
            scores = []
            for i, c in words.items():
                s = sum(m * math.log1p((n - df[w] + .5) / (df[w] + .5)) * c[w] * 2.2 / (
                    c[w] + 1.2 * (.25 + .75 * length[i] / average)) for w, m in words[q].items() if w in c)
                if s > 0:
                    scores.append((-round(s, 9), i))
            want[q] = [i for _, i in sorted(scores)[:10]]
    got = collections.defaultdict(dict)
    for r in run(spark, "op5_topk_search"):
        got[r["query_id"]][r["rank"]] = r["doc_id"]
    assert {q: [v[k] for k in sorted(v)] for q, v in got.items()} == want


def test_shard_pruning_is_exact(monkeypatch):
    monkeypatch.setattr(search, "COMMON_WORDS", 3)
    rng = np.random.default_rng(1)
    vocabulary = np.arange(60, dtype=np.uint64)
    terms = [np.unique(rng.zipf(1.3, rng.integers(1, 30)).astype(np.uint64) % 60) for _ in range(700)]
    counts = [rng.integers(1, 5, len(t)).astype("<u4") for t in terms]
    lengths = np.array([c.sum() for c in counts])
    shard = search.Shard(np.arange(700), lengths, terms, counts, vocabulary, lengths.mean())
    for _ in range(20):
        query = np.unique(rng.integers(0, 60, 12))
        weight = rng.random(len(query))
        by = dict(zip(query.tolist(), weight, strict=True))
        want = np.array([sum(by.get(int(t), 0) * c * 2.2 / (c + 1.2 * (.25 + .75 * n / lengths.mean()))
                             for t, c in zip(ts, cs, strict=True)) for ts, cs, n in zip(terms, counts, lengths, strict=True)])
        docs, scores = shard.top(query, weight, shard.common([query], [weight])[0], 10, -np.inf)
        best = np.lexsort([shard.ids[docs], -scores])[:10]
        assert scores[best] == pytest.approx(np.sort(want)[::-1][:10])


def test_leaks(spark, texts):
    clean = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = {(i, r["item_id"]) for i, t in texts.items() for r in items if clean(r["text"]) in clean(t)}
    got = {(r["doc_id"], r["item_id"]): r for r in run(spark, "op7_benchmark_decontamination")}
    assert set(got) >= want and want
    for (i, item), r in got.items():
        assert clean(texts[i][r["start"]:r["stop"]])[:20] or (i, item) in want


def edits(pattern, text):
    """Fewest edits that turn ``pattern`` into some part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern):
        new = [i + 1]
        for j, t in enumerate(text):
            new.append(min(row[j] + (p != t), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_edited_passages_are_found_up_to_the_budget():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("etaoin srh") for _ in range(rng.randint(2, 9))).strip() or "x"
    items = [(k, " ".join(word() for _ in range(rng.randint(6, 40)))) for k in range(25)]
    index = decontaminate.Index([w for k, t in items for w in decontaminate.windows(k, t)])
    for k, t in items:
        for rate in (0.0, 0.03, 0.06, 0.1, 0.2):
            chars = list(t)
            for _ in range(int(rate * len(chars))):
                at = rng.randrange(len(chars))
                chars[at:at + 1] = rng.choice([[], ["q"], ["q", chars[at]]])
            doc = " ".join(word() for _ in range(50)) + " " + "".join(chars) + " " + " ".join(word() for _ in range(50))
            found = {h[1] for h in index.search(["other text", doc, ""]) if h[0] == 1}
            points = decontaminate.normalise(doc)[0].tolist()
            want = {w.item for w in index.block if edits(w.chars.tolist(), points) <= w.budget}
            assert found == want


def test_language(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").selectExpr(
        "doc_id", "text", "lang AS truth", "CASE WHEN doc_id % 2 = 0 THEN lang END AS lang",
        "concat('http://', source, '.', lang, '/') AS source")
    got = {r["doc_id"]: r["language"] for r in langid.identify(rows).collect()}
    truth = {r["doc_id"]: r["truth"] for r in rows.collect()}
    hidden = [i for i in truth if i % 2]
    assert sum(got[i] == truth[i] for i in hidden) / len(hidden) > 0.98


def test_language_evidence_decides_short_texts(spark):
    long = [(i, ("the house and the garden of the man with water " if i % 2 else "das haus und der garten von dem mann mit wasser ") * 3,
             "en" if i % 2 else "de", f"http://h{i % 2}.{'uk' if i % 2 else 'de'}/") for i in range(80)]
    short = [(1000, "in", None, "http://h1.uk/x"), (1001, "in", None, "http://h0.de/x"), (1002, "in", "de-AT", None),
             (1003, "in", "en_GB", None), (1004, "in", None, "http://new.uk"), (1005, "in", None, "http://new.de"),
             (1006, "xqzjvwkq zzxqj qqkzx vvjqx zkqjx wvqzk", None, "http://h1.uk/")]
    df = spark.createDataFrame(long + short, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["language"] for r in langid.identify(df).collect()}
    assert [got[i] for i in range(1000, 1007)] == ["en", "de", "de", "en", "en", "de", "und"]


def test_pages(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in run(spark, "op6_html_extraction"):
        inside = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(stdhtml.unescape(re.sub(r"<br>|</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_wrappers_without_article_marks(spark):
    def page(k):
        items = "".join(f"<li><a href=/{k}{j}>Link {k} {j}</a></li>" for j in range(k % 4 + 2))
        paragraphs = "".join(f"<p>Sentence {k} {j} of the story, with <i>some</i> more words.</p>" for j in range(k % 5 + 1))
        extra = "<div class='x1'>Read this box on each page</div>" if k % 2 else ""
        note = f"<div id=comments><p>I disagree {k}</p></div>" if k % 3 else ""
        return (f"<html><body><div class=top>The Daily</div><ul>{items}</ul><div class=b><h2>Title {k}</h2>{extra}"
                f"{paragraphs}</div>{note}<div class=end>All rights</div></body></html>")

    df = spark.createDataFrame([(k, f"https://news.test/{k}", page(k)) for k in range(12)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.main_text(df).collect()}
    for k, text in got.items():
        assert text == "\n".join([f"Title {k}"] + [f"Sentence {k} {j} of the story, with some more words." for j in range(k % 5 + 1)])


def test_alignment_generalises():
    def wrap(tokens):
        texts = [("t", "", 0.0)] * tokens.count("#")
        return html.wrapper_of(html.fold(tokens), texts, tokens)

    one = wrap("ul li # li # li # /ul div # /div".split())
    two = wrap("ul li # /ul h2 # div # /div".split())
    assert html._shape(html.align(one, two)) == "ul (li #)+ /ul h2? #? div # /div"


def test_surrogates(spark):
    text = ("Ask Mr. John Smith or Mrs. Anna Smith: JOHN.DOE@MAIL.CO.UK, john.doe@mail.co.uk; +1 (988) 555-2485 or 988-555-2485. "
            "Card 4111 1111 1111 1111 and 4111-1111-1111-1111, not 4111111111111112; 10.0.0.1; version 3.1.4. Господин Иван Петров "
            "token = \"04dbebab91ab85687d33\" DE89 3704 0044 0532 0130 00")
    df = spark.createDataFrame([(1, text), (2, "mail john.doe@mail.co.uk twice john.doe@mail.co.uk"), (3, "nothing in 2024")],
                               "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.anonymise(df, "key").collect()}
    mail = re.findall(r"\S+@[\w.]*\w", got[1])
    assert mail[0].lower() == mail[1] and got[2].split()[1] == got[2].split()[3] == mail[1] and mail[1] != "john.doe@mail.co.uk"
    phones = re.findall(r"\+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3})-(\d{3})-(\d{4})", got[1])[0]
    assert phones[:3] == phones[3:] and phones[:3] != ("988", "555", "2485")
    cards = re.search(r"Card ([\d ]+) and ([\d-]+), not 4111111111111112", got[1])
    digits = [re.sub(r"\D", "", c) for c in cards.groups()]
    luhn = sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(digits[0][::-1])) % 10
    assert digits[0] == digits[1] != "4" + "1" * 15 and luhn == 0 and cards[1][4] == " " and cards[2][4] == "-"
    names = re.match(r"Ask Mr\. (\w+) (\w+) or Mrs\. (\w+) (\w+):", got[1]).groups()
    assert names[1] == names[3] != "Smith" and names[0] in pii.GIVEN["latin", "m"] and names[2] in pii.GIVEN["latin", "f"]
    iban = re.search(r"DE\d\d [\d ]+", got[1])[0].replace(" ", "").strip()
    assert int(iban[4:] + "1314" + iban[2:4]) % 97 == 1
    assert "version 3.1.4" in got[1] and "10.0.0.1;" not in got[1] and "Иван" not in got[1] and got[3] == "nothing in 2024"
    assert re.search(r'token = "[0-9a-f]{20}"', got[1]) and "04dbebab" not in got[1]
    other = pii.anonymise(df, "other key").where("doc_id = 2").first()["text"]
    assert other != got[2]


def test_surrogates_stay_distinct(spark):
    rows = [(k, f"Mr. {chr(65 + k % 26)}{'abcdefghij'[k // 26]}x met 10.{k % 3}.{k // 3}.7") for k in range(200)]
    rows += [(1000 + k, f"Frau {n} kam") for k, n in enumerate(["Aa", "Bb"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.anonymise(df, "k").collect()}
    assert len({got[k].split()[1] for k in range(200)}) == 200 and len({got[k].split()[3] for k in range(200)}) == 200


def test_conversations_against_sql(spark):
    rows = [(1, 0, "a", "Hello there.\nHow are you today?\nI have a question: why?"),
            (1, 1, "b", "Someone wrote:\n> How are you today?\nFine thanks."),
            (1, 2, "a", ">> How are you today?\n> Fine thanks.\nGood. And you?"),
            (1, 3, "c", "> How are you\n> today?\n> I have a question: why?\nBecause."),
            (1, 4, "d", "> > How are you today?\n\n> Good. And you?\nMe too"), (1, 5, "e", None),
            (2, 0, "u", "x"), (2, 1, "v", "> x\ny"), (2, 2, "w", "> nothing like it\nz"), (2, 3, "w", ""), (2, 4, "v", "> z\n> y\nq")]
    ddl = "conv_id long, turn long, role string, text string"
    got = chat.conversations(spark.createDataFrame(rows, ddl))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({chat.ORACLE})").fetchall()
    have = [tuple(r) for r in got.collect()]
    assert sorted(map(repr, have)) == sorted(map(repr, want))
    order = [r["turn"] for r in got.where("conv_id = 1").orderBy("order_key").collect()]
    assert order == [0, 1, 2, 4, 3, 5]


def test_pipeline(spark, texts):
    clean = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    texts = {i: t for i, t in texts.items() if re.search(r"[^\W\d_]", t)}
    first = groups(texts)
    items = [clean(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {r["doc_id"] for r in run(spark, "op7_benchmark_decontamination")}
    want = {i for i in texts if first[i] == i and i not in leaked}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == want
    assert not any(item in clean(texts[i]) for i in want for item in items)
