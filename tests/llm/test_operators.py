"""The ten operators against plain Python on small tables with every awkward row."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicloom.llm import bwt, byte_bpe, histogram_shards, host_quality, minmax, packing, pca_tiles, pii, queries, substrings, toxicity, url_rules
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id int, h string, bucket int, name string"


def prose(seed, n, words=400):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeéß") for _ in range(r.randint(1, 7))) for _ in range(n))


BASE = prose(1, 120)
PASSAGE = prose(2, 60)


def changed(text, k, seed):
    words, r = text.split(), random.Random(seed)
    for _ in range(k):
        words[r.randrange(len(words))] = "x" + str(r.randrange(10**6))
    return " ".join(words)


TEXTS = [
    None,
    "",
    " \t\n\r",
    "one",
    "two Words",
    "Two words",
    "a b c",
    "a b c d",
    "word " * 300,
    "a" * 5000,
    "\n".join(["same line here", "other line", "same line here", "  ", "  "] * 8),
    BASE,
    BASE,
    BASE.upper(),
    changed(BASE, 1, 3),
    changed(BASE, 2, 4),
    changed(BASE, 9, 5),
    PASSAGE + " " + prose(6, 80),
    prose(7, 90) + "\n" + PASSAGE,
    PASSAGE[:300] + prose(8, 10) + PASSAGE[100:],
    prose(9, 20_000),
    "<|endoftext|> don't I'm 12 ²½ ΣΑΣ e\u0301 \x1c\x1d \x85 \u2003 日本語 🙂🙂 \ufeff",
    "'''sss 's 'S !!'re   \n\n  tail  ",
    "mail a.b+c@ex-am.co.uk,x@y.z@w.q b@c. 1.2.3.4 300.1.1.1 1.2.3.4.5 0001.2.3.4 12.34",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 49927398716 " + "1" * 40 + " 12345678901234",
    "+1 (212) 555-0100, +44 20 7946 0958 99, +1 23, +12345678901234567 + 1 call 212-555-0199",
    'token = "' + "0a1b2c3d4e5f" * 4 + '" sha1 ' + "f0e1d2c3b4" * 4,
    "#*$%&|<> " * 20,
    "\u00e9" * 60 + "tail",
    "x" + "\u00e9" * 60 + "other",
]


@pytest.fixture(scope="module")
def rows():
    out = [(i * 3 % 97, t) for i, t in enumerate(TEXTS)]
    assert len({i for i, _ in out}) == len(out)
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    more = [(i, t, "en", None if i % 5 == 0 else f"src{i % 3}", 1, i, "h", 2, "n") for i, t in rows]
    return spark.createDataFrame(more, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def odd(spark, rows):
    """Repeated rows, one id with two texts, and null ids."""
    more = [*rows, *rows[8:14], (rows[14][0], "another text"), (None, BASE), (None, None), (None, PASSAGE)]
    return spark.createDataFrame([(i, t, None, None, None, None, None, None, None) for i, t in more], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def whole(spark):
    df = queries.table(spark, FOLDER, "documents")
    return df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def by_id(df, id_column="doc_id"):
    out = {r[id_column]: r for r in df.collect()}
    return out


def test_every_operator_takes_odd_and_empty_tables(spark, odd, nothing, rows):
    import public_tokenizers

    ranks = byte_bpe.read_ranks(queries.vocabulary("byte_bpe_50k.tiktoken"))
    chain = toxicity.fit([(toxicity.example({"good"}), False), (toxicity.example({"idiot"}), True)] * 6)
    single = {
        "quality": host_quality.quality,
        "pii": pii.find,
        "shards": histogram_shards.shard,
        "toxicity": lambda d: toxicity.score(d, chain),
        "minmax": minmax.near_duplicates,
        "bpe": lambda d: byte_bpe.decode(byte_bpe.encode(d, ranks, public_tokenizers.PATTERN), ranks),
        "repeats": substrings.remove_repeats,
    }
    for name, operator in single.items():
        assert operator(odd).count() == odd.count(), name
        assert operator(nothing).count() == 0, name
    assert packing.pack(odd, queries.word_definition()).select("doc_id").distinct().count() > 20
    assert packing.pack(nothing, queries.word_definition()).count() == 0
    got = [tuple(r) for r in minmax.near_duplicates(odd).where("doc_id IS NULL").collect()]
    assert len(got) == 3 and all(c is None and kept for *_, c, kept in got)
    assert toxicity.train(nothing, nothing.withColumn("toxic", F.lit(1))).features == {}
    urls = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.filter_urls(urls, queries.HOST_RULES).count() == 0


def test_host_quality(docs, rows, whole):
    for df, own in ((docs, rows), whole):
        got = by_id(host_quality.quality(df))
        assert len(got) == len(own)
        for i, text in own:
            r = got[i]
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute.rule_counts(text), i
            assert r["kept"] == (not r["base_failed"] and not r["host_failed"])


def test_host_rates_shrink(spark):
    rows = [("big", k < 900) for k in range(1000)] + [("good", k < 10) for k in range(1000)] + [("one", True)] + [(f"h{n}", k == 0) for n in range(20) for k in range(20)]
    got = by_id(host_quality.host_verdicts(spark.createDataFrame(rows, "host string, base_failed boolean")), "host")
    assert got["big"]["host_failed"] and not got["good"]["host_failed"]
    assert got["one"]["rate"] < 0.9 and abs(got["big"]["rate"] - 0.9) < 0.01


def test_personal_data(docs, rows, whole):
    for df, own in ((docs, rows), whole):
        got = by_id(pii.find(df).select("doc_id", "spans", *queries.span_columns(None)[:-1]))
        for i, text in own:
            base = brute.base_spans(text)
            assert [(s["start"], s["kind"], s["end"]) for s in got[i]["spans"] if s["strict"]] == base, i
            assert got[i]["base_sha256"] == brute.sha(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base).encode())
            assert got[i]["n_card"] == sum(k == 2 for _, k, _ in base)


def test_estimation_prefers_supported_votes():
    good, bad = pii.code(pii.SECRET, (0, 1, 0, 1, 0, 0, 1), 40), pii.code(pii.SECRET, (0, 1, 0, -1, -1, 0, 0), 40)
    patterns = [(good, 500), (bad, 800)]
    p = pii.train(patterns, pii.estimate(patterns))
    assert p[good] > 0.9 > 0.3 > p[bad]


def test_masking(spark):
    df = spark.createDataFrame([(1, "call +1 (212) 555-0100 now"), (2, None), (3, "x")], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in pii.rewritten(df).collect()}
    assert out == {1: "call <phone> now", 2: None, 3: "x"}


def test_shards_hold_equal_bytes(spark, docs, rows, whole):
    copies = spark.createDataFrame([(i, "copy " * 50 if i % 3 == 0 else prose(i, 5 + i % 40)) for i in range(1200)], "doc_id long, text string")
    for df, n in ((docs, len(rows)), (whole[0], len(whole[1])), (copies, 1200)):
        got = histogram_shards.shard(df, 8).collect()
        assert len(got) == n
        size, slots = Counter(), defaultdict(list)
        for r in got:
            assert r["size"] == len((r["text"] or "").encode()) + 1
            size[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        largest = max(r["size"] for r in got)
        assert max(size.values()) - min(size[s] for s in range(8)) <= 2 * largest + 0.01 * sum(size.values())


def test_toxicity_chain():
    r = random.Random(5)
    common = ["the", "of", "and", "river", "stone", "walk", "green", "paper"]

    def row(bad):
        words = {r.choice(common) + str(r.randrange(30)) for _ in range(20)}
        return words | ({r.choice(["idiot", "worthless", "scum", "moronic"])} if bad else set()), bad

    rows = [row(n % 5 == 0) for n in range(900)]
    chain = toxicity.fit([(toxicity.example(words), bad) for words, bad in rows[:600]])
    assert [len(w) - len(chain.features) for w in chain.weights] == [1, 2, 3]
    import numpy as np

    ids = [np.array(sorted({chain.features[f] for w in words for f in toxicity.cut(w) if f in chain.features}), np.int64) for words, _ in rows[600:]]
    p = chain.probabilities(ids)[:, -1] >= chain.threshold
    assert sum(a != b for a, (_, b) in zip(p, rows[600:])) <= 3


def test_near_duplicates(docs, rows, whole, spark):
    family = [(i, changed(BASE, i % 7, i)) for i in range(200)]
    for df, own in ((docs, rows), whole, (spark.createDataFrame(family, "doc_id long, text string"), family)):
        for width in (4, 5):
            got = by_id(minmax.near_duplicates(df, width=width))
            sets, component = brute.near_duplicates(own, width)
            assert {i: got[i]["n_shingles"] for i in got} == {i: len(s) for i, s in sets.items()}
            assert {i: got[i]["component_id"] for i in got} == component
            assert all(got[i]["kept"] == (i == component[i]) for i in got)


def vector_rows():
    r = random.Random(8)
    out, n = [], 0
    for label in (1, 2, 2, None):
        centres = [[r.gauss(0, 1) for _ in range(24)] for _ in range(12)]
        for c in centres:
            for spread in (0.0, 0.0, 0.05, 0.1, 0.14, 0.2):
                out.append((n, [float(x + r.gauss(0, spread) * 1.2) for x in c], label))
                n += 1
    out += [(n, None, 1), (n + 1, [0.0] * 24, 1), (n + 2, [math.nan] * 24, 1), (n + 3, [1.0, None] * 12, 1), (n + 4, [1.0] * 23, 1), (n + 5, [math.inf] + [1.0] * 23, 1), (n + 6, [], 1)]
    return out


def test_near_vectors(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("box", F.lit(1)).withColumn("rep", F.lit("r"))
    got = by_id(pca_tiles.near_vectors(df, tile_rows=16), "vec_id")

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))

    real = [(i, v, k) for i, v, k in rows if k is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = [(a, b) for a, v, k in real for b, w, m in real if a < b and k == m and len(v) == len(w) and cosine(v, w) >= 0.98]
    times = Counter(x for pair in links for x in pair)
    component = brute.components([i for i, *_ in rows], links)
    assert len(links) > 50
    assert {i: got[i]["n_links"] for i in got} == {i: times[i] for i, *_ in rows}
    assert {i: got[i]["component_id"] for i in got} == component
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert pca_tiles.near_vectors(empty).count() == 0


def test_url_rules(spark):
    urls = [
        "https://A.Example.NET/en/x?q#f", "http://example.net", "http://net/en/", "http://xnet/", "http://b.example.com/de/1", "http://example.com/de", "http://example.com/en/",
        "http://q.org/fr/", "http://q.org/fr", "no scheme", None, "", "://", "x://?://y.net/", "http://win-casino.biz/play/1", "http://a.biz:80/#x", "http://h\n.net/en/\n?",
    ]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(3))
    got = by_id(url_rules.filter_urls(df, queries.HOST_RULES), "page_id")
    for i, url in enumerate(urls):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, path = rest[:cut].translate({k: k + 32 for k in range(65, 91)}), rest[cut:].split("?")[0].split("#")[0]
        best = max((r for r in queries.HOST_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)), key=lambda r: len(r.name), default=None)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best.name), url
        assert r["verdict"] == best.verdict if best else r["verdict"] in ("allow", "block")


def test_rules_are_mined(spark):
    rows = [(["p:win", "h:a", f"p:{i % 7}"], "block") for i in range(60)] + [(["p:news", "h:a", f"p:{i % 5}"], "allow") for i in range(90)]
    rules = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, label string"), min_support=0.05)
    index = url_rules.inverted_index(rules)
    assert url_rules.decide(["h:a", "p:win"], index)[0] == "block"
    assert url_rules.decide(["h:b", "p:news"], index)[0] == "allow"
    assert url_rules.decide(["h:c"], index) == ("allow", 0.0)


def test_rules_of_four_tokens_are_mined(spark):
    four = ["h:a", "p:b", "p:c", "p:d"]
    rows = [(four, "block")] * 40 + [([t for t in four if t != gone], "allow") for gone in four for _ in range(40)]
    rules = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, label string"), min_support=0.05)
    assert (tuple(four), "block", 1.0, 0.2) in rules
    assert url_rules.decide(four, url_rules.inverted_index(rules)) == ("block", 1.0)


def test_last_tokens_of_long_urls_are_mined(spark):
    r = random.Random(4)
    rows = [([f"p:{w}" for w in r.sample(range(96), 24)] + [last], label) for last, label in (("p:bad", "block"), ("p:good", "allow")) for _ in range(100)]
    index = url_rules.inverted_index(url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, label string"), min_support=0.15))
    assert url_rules.decide(["p:bad"], index) == ("block", 1.0)


def test_long_templates_are_mined_whole(spark):
    path = "/".join(f"{c}{d}" for c in "abcdef" for d in "vwxyz")
    urls = [f"http://x.net/{path}/end"] * 30 + ["http://x.org/fr/end"] * 30 + ["http://y.biz/end", f"http://y.biz/{path}", "http://y.biz/fr/av", "http://y.biz/fr/av/aw"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = by_id(url_rules.filter_urls(df, queries.HOST_RULES), "page_id")
    assert [(got[i]["verdict"], got[i]["confidence"]) for i in range(60, 64)] == [("allow", 0.0), ("block", 1.0), ("block", 1.0), ("block", 1.0)]


def test_groups_decide_as_their_tokens(spark):
    r = random.Random(6)
    rows = [([t for t in "abcdefgh" if r.random() < 0.6] + ["p:x", "p:y"] * (k % 3 == 0) + ["p:v", "p:w", "p:z"] * (k % 4 > 1), "block" if k % 3 == 0 or r.random() < 0.3 else "allow") for k in range(80)]
    df = spark.createDataFrame(rows, "tokens array<string>, label string")
    found, groups = url_rules.mined(df, min_support=0.05)
    assert groups["p:x"] == groups["p:y"] != groups["p:v"]
    compact, index = url_rules.inverted_index(found.collect()), url_rules.inverted_index(brute.rules(rows, 0.05, 0.8))
    for _ in range(300):
        url = r.sample([*"abcdefghi", "p:x", "p:y", "p:v", "p:w", "p:z"], r.randint(0, 9))
        assert url_rules.decide(url, compact, groups=groups) == url_rules.decide(url, index), url
    assert [x[:3] for x in url_rules.mine(df, min_support=0.05)] == [x[:3] for x in sorted(brute.rules(rows, 0.05, 0.8))]


def test_support_holds_for_any_number_of_rules(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "SALTED", 5)
    r = random.Random(7)
    hot = [f"http://{r.choice(['big', 'huge'])}.net/" + "/".join(w for w in "abcdefghij" if r.random() < 0.7) for _ in range(300)]
    urls = [*hot, *["http://rare.net/seldom/one"] * 4, "http://other.biz/seldom", "http://other.biz/a/b/c", "http://other.biz/none", "http://some.biz/j/i", None, ""]
    df = spark.createDataFrame([(k % 290, u) for k, u in enumerate(urls)], "page_id long, url string")
    rules = [*queries.HOST_RULES, url_rules.HostRule("huge.net", "/", url_rules.ALLOW)]
    few = sorted(map(tuple, url_rules.filter_urls(df, rules, most_rules=10, min_support=0.01).collect()), key=repr)
    many = sorted(map(tuple, url_rules.filter_urls(df, rules, most_rules=1_000_000, min_support=0.01).collect()), key=repr)
    assert few == many and len(few) == len(urls)
    verdicts = {(h, p): (v, c) for _, h, p, _, v, c in few}
    assert verdicts["other.biz", "/seldom"] == ("block", 1.0) and verdicts["other.biz", "/none"] == ("allow", 0.0)


def test_packing(docs, rows, whole):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    for df, own in ((docs, rows), whole):
        got = defaultdict(list)
        sequences = set()
        for r in packing.pack(df, queries.word_definition()).collect():
            got[r["doc_id"]].append(r)
            assert r["sequence_id"] not in sequences and r["offset"] == 0
            sequences.add(r["sequence_id"])
        for i, text in own:
            ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
            at = 0
            for r in sorted(got[i], key=lambda r: r["start"]):
                n = r["length"]
                assert r["start"] == at and n & (n - 1) == 0 and n <= 4096 and r["doc_tokens"] == len(ids)
                assert r["ids"] == brute.array("I", ids[at : at + n]).tobytes(), i
                at += n
            assert at == len(ids)


@pytest.fixture(scope="module")
def plain_texts():
    """Every character that texts may hold to be cut to words outside the library, in many neighbourhoods."""
    r = random.Random(11)
    every = [chr(c) for c in range(256) if packing.PLAIN.fullmatch(chr(c))]
    texts = ["".join(r.choice(every) for _ in range(r.randint(0, 300))) for _ in range(300)]
    texts += ["".join(r.choice("aé,.!' 'stvemldr1\n\t<|") for _ in range(r.randint(0, 300))) for _ in range(300)]
    return [*texts, "".join(every), *(a + c + b for c in every for a, b in ("ab", "''", "1 ", " .", ".s"))]


def test_words_are_cut_as_the_tokenizer_cuts_them(plain_texts):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    tokenizer = packing.WordTokenizer(queries.word_definition())
    for texts in (plain_texts, plain_texts[::-1], [""], ["", "日本"], ["日本", "a,b. <|endoftext|>"]):
        ids, counts = tokenizer(texts, brute.array("I", [2]).tobytes())
        want = [[*known.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_other_rules_for_words_are_left_to_the_tokenizer(spark):
    import json

    from tokenizers import Tokenizer

    rules = json.loads(queries.word_definition())
    rules["normalizer"] = {"type": "NFC"}
    known = Tokenizer.from_str(json.dumps(rules))
    texts = ["Two words, one.", "it's", "", None, "日本 b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = defaultdict(bytes)
    for r in sorted(packing.pack(df, json.dumps(rules)).collect(), key=lambda r: r["start"]):
        got[r["doc_id"]] += bytes(r["ids"])
    for i, text in enumerate(texts):
        assert got[i] == brute.array("I", [*known.encode(text or "", add_special_tokens=False).ids, 2]).tobytes()


def test_packing_looks_at_a_repeated_word_once(monkeypatch):
    class Counted:
        seen = 0

        def findall(self, text):
            Counted.seen += len(text)
            return words.findall(text)

    words = packing.WORDS
    monkeypatch.setattr(packing, "WORDS", Counted())
    tokenizer = packing.WordTokenizer(queries.word_definition())
    tokenizer([" ".join(["some word, and another: 12 don't."] * 500)] * 4)
    assert 0 < Counted.seen < 100


def test_byte_bpe(docs, rows, whole):
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.read_ranks(queries.vocabulary("byte_bpe_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df, own in ((docs, rows), whole):
        got = by_id(byte_bpe.decode(byte_bpe.encode(df, ranks, public_tokenizers.PATTERN), ranks))
        for i, text in own:
            assert list(brute.array("I", bytes(got[i]["ids"]))) == known.encode_ordinary(text or ""), i
            assert bytes(got[i]["decoded"]) == (text or "").encode()
    r = random.Random(3)
    for _ in range(300):
        piece = bytes(r.choice(b"abe ts\xc3\xa9") for _ in range(r.randint(1, 60)))
        assert byte_bpe.merge(piece, ranks) == known.encode_single_piece(piece) if hasattr(known, "encode_single_piece") else True
    long = "ab" * 30_000
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    assert list(brute.array("I", encoder(long))) == known.encode_ordinary(long)


def test_repeats(docs, rows, whole, spark):
    shared = [(i, prose(i, 30) + PASSAGE[i % 9 :] + prose(i + 500, 20) + ("z" * (40 + i % 30))) for i in range(120)]
    for df, own in ((docs, rows), whole, (spark.createDataFrame(shared, "doc_id long, text string"), shared)):
        got = by_id(substrings.remove_repeats(df))
        for i, (b, kept, spans) in brute.repeats(own).items():
            assert (got[i]["n_bytes"], bytes(got[i]["kept"])) == (len(b), kept), i
            assert [tuple(s) for s in got[i]["spans"]] == spans


def test_hot_grams_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", 5)
    monkeypatch.setattr(substrings, "STRIDE", 100)
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(substrings)
    try:
        own = [(i, prose(i, 40) + PASSAGE + prose(i + 900, 3)) for i in range(60)] + [(70, PASSAGE * 3), (71, BASE), (72, BASE + BASE)]
        got = by_id(substrings.remove_repeats(spark.createDataFrame(own, "doc_id long, text string")))
        for i, (b, kept, spans) in brute.repeats(own).items():
            assert bytes(got[i]["kept"]) == kept and [tuple(s) for s in got[i]["spans"]] == spans, i
    finally:
        cloudpickle.unregister_pickle_by_value(substrings)


@pytest.mark.parametrize("kinds, least", [(1, 50), (2, 7), (26, 50), (256, 50)])
def test_least_owners_take_few_sorts(monkeypatch, kinds, least):
    r = random.Random(kinds)
    base = bytes(r.randrange(kinds) for _ in range(20_000))
    pieces = [base[a : a + r.randint(1, 90)] for a in (r.randrange(len(base)) for _ in range(600))] + [b"", base[-least:], base[: least - 1]]
    owners = np.array([r.randrange(99) for _ in pieces])
    best, want, at = {}, {}, 0
    for piece, owner in zip(pieces, owners.tolist()):
        for i in range(len(piece) - least + 1):
            best[piece[i : i + least]] = min(best.get(piece[i : i + least], owner), owner)
    for piece in pieces:
        want |= {at + i: best[piece[i : i + least]] for i in range(len(piece) - least + 1)}
        at += len(piece)
    sorts, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda *a, **k: sorts.append(len(a[0])) or argsort(*a, **k))
    places, smallest = bwt.least_owner(np.frombuffer(b"".join(pieces), np.uint8), np.array([len(p) for p in pieces]), owners, least)
    assert dict(zip(places.tolist(), smallest.tolist())) == want and len(places) == len(want)
    # Strings of 7 symbols, of 21 and of 50, and once the transform: no more than ``least`` symbols are looked at.
    assert len(sorts) <= 4


def test_repeated_rows_take_nothing_from_each_other(spark):
    df = spark.createDataFrame([(1, BASE), (1, BASE), (2, BASE), (None, BASE)], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]))
    got = sorted((r["doc_id"] or 99, len(r["kept"])) for r in substrings.remove_repeats(df).collect())
    assert got == [(1, len(BASE.encode())), (1, len(BASE.encode())), (2, 0), (99, 0)]
