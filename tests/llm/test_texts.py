"""Suffix sorting, tokens, packing, repetition, licences and page text against brute force."""
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from fleetlake.llm import html_text, licenses, packing, repetition, suffixes, tokens
from fleetlake.llm.license_texts import TEMPLATES

SF = "/root/testdata/sf0.001"


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


# -- operator 5 --

def brute_spans(texts, span):
    often = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t), bool)
        for i in range(len(t) - span + 1):
            if often[t[i : i + span]] > 1:
                cover[i : i + span] = True
        kept = bytes(b for b, c in zip(t, cover) if not c)
        out.append((len(t), int(cover.sum()), int((np.diff([0, *cover.astype(int)]) == 1).sum()), kept))
    return out


def test_deep_shallow_sorts_with_common_prefixes():
    rng = random.Random(3)
    for _ in range(400):
        letters = rng.choice([b"ab", b"a", bytes(range(256))])
        base = bytes(rng.choice(letters) for _ in range(60))
        strings = [base[: rng.randint(0, 60)] + bytes(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 25))]
        order, common = suffixes.deep_shallow(strings, 0, rng.choice([8, 16, 32]))
        assert [strings[i] for i in order] == sorted(strings)
        for k in range(1, len(order)):
            a, b = strings[order[k - 1]], strings[order[k]]
            assert a[: common[k]] == b[: common[k]] and a[common[k] : common[k] + 1] != b[common[k] : common[k] + 1] or a == b


def test_anchors_depend_on_content_only():
    rng = random.Random(4)
    s = bytes(rng.choice(b"abc ") for _ in range(400))
    places = []
    for _ in range(20):
        left, right = (bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 500))) for _ in "lr")
        at = suffixes.anchors(left + s + right)
        places.append({int(a) - len(left) for a in at if len(left) <= a < len(left) + 200})
    assert set.intersection(*places)


def made_texts(rng, n):
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(20, 120))) for _ in range(8)]
    def one():
        s = ""
        for _ in range(rng.randint(0, 8)):
            c = rng.random()
            if c < 0.5:
                p = rng.choice(passages)
                i = rng.randint(0, len(p))
                s += p[i : rng.randint(i, len(p))] if rng.random() < 0.5 else p
            elif c < 0.6:
                s += rng.choice("aé") * rng.randint(0, 90)
            elif c < 0.7:
                s += "xy z" * rng.randint(0, 20)
            else:
                s += "".join(rng.choice("abcdefgh é") for _ in range(rng.randint(0, 60)))
        return s
    return [one() for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"most_sorted": 3}])
def test_repeats_random(spark, options):
    texts = [*made_texts(random.Random(6), 150), None, "", "a" * 300, "b" * 39, "c" * 40, "d" * 41]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffixes.remove_repeats(df, span=40, **options).collect()}
    assert [got[i] for i in range(len(texts))] == brute_spans([(t or "").encode() for t in texts], 40)


def test_repeats_on_documents_and_odd_rows(spark, odd_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffixes.remove_repeats(docs).collect()}
    assert [got[r["doc_id"]] for r in rows] == brute_spans([(r["text"] or "").encode() for r in rows], 400)
    rows = odd_docs.orderBy("n_chars").collect()
    out = suffixes.remove_repeats(odd_docs, keep=("n_chars", "id", "h", "kept")).orderBy("n_chars").collect()
    want = brute_spans([(r["text"] or "").encode() for r in rows], 400)
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r[-1])) for r in out] == want
    assert [r["h"] for r in out] == [r["h"] for r in rows]
    assert suffixes.remove_repeats(odd_docs.limit(0)).count() == 0


def test_runs_of_few_words_stay(spark):
    words = [f"w{i}" for i in range(400)]
    short, long = " ".join(words[:20]), " ".join(words[100:151])
    texts = [f"one {short} two {long} three", f"{long} four {short}", "five"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: (r["n_spans"], r["text"]) for r in suffixes.remove_repeats(df, span=60, least_words=51, as_text=True).collect()}
    assert {i: " ".join(t.split()) for i, (_, t) in out.items()} == {0: f"one {short} two three", 1: f"four {short}", 2: "five"}
    assert [out[i][0] for i in range(3)] == [1, 1, 0]


def test_long_text_that_repeats_itself(spark, monkeypatch):
    rng = random.Random(11)
    line = "".join(rng.choice("abcdefgh ") for _ in range(997))
    rows = [(0, line * 4000), (1, line * 2 + "end"), (2, "".join(rng.choice("abcdefgh ") for _ in range(3000)))]  # 4 MB in one text
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: tuple(r)[1:4] for r in suffixes.remove_repeats(df).drop("kept").collect()}
    assert out == {0: (997 * 4000, 997 * 4000, 1), 1: (1997, 1994, 1), 2: (3000, 0, 0)}
    packed = zstandard.ZstdCompressor(level=1).compress(rows[0][1].encode())
    batch = pa.RecordBatch.from_arrays([pa.array([packed] * 50, pa.binary()), pa.array([[{"a": 0, "b": 5}]] * 50)], names=["packed", "spans"])
    parts = list(suffixes._cut(iter([batch]), False, 0))
    assert sum(p.num_rows for p in parts) == 50 and max(p.nbytes for p in parts) < 4 * suffixes._OUT_BYTES


# -- operators 6 and 4 --

def test_encoder_equals_library():
    rng = random.Random(1)
    parts = ["a", "b", "'s", "don't", " ", "  ", "\n", "\t", "\r\n", " ", "\x1c", "\x85", "é", "１", "12", "!!", "<|endoftext|>", "中文", "​", "x" * 70]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    want = [x.ids for x in library().encode_batch(texts, add_special_tokens=False)]
    for a in range(0, len(texts), 1000):
        got = tokens.encoder(tokens.VOCABULARY, "ids").encode(texts[a : a + 1000])
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == want[a : a + 1000]
        assert tokens.encoder(tokens.VOCABULARY, "count").encode(texts[a : a + 1000]) == [len(x) for x in want[a : a + 1000]]


def test_token_counts(spark, odd_docs):
    for docs in (spark.read.parquet(f"{SF}/documents.parquet"), odd_docs):
        t = library()
        want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()), len(t.encode(r["text"] or "", add_special_tokens=False).ids))
                      for r in docs.select("doc_id", "text").collect())
        out = tokens.count_tokens(docs)
        got = out.collect()
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)
    assert tokens.count_tokens(odd_docs.limit(0)).count() == 0


def test_token_counts_with_sentencepiece(spark):
    import sentencepiece

    texts = ["Hello  world", "", None, "é\n x"]
    sp = sentencepiece.SentencePieceProcessor(model_file=tokens.vocabulary_path("piece_bpe_32k.model"))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = [r["n_tokens"] for r in tokens.count_tokens(df, vocabulary="piece_bpe_32k.model").orderBy("doc_id").collect()]
    assert got == [len(sp.encode(t or "")) for t in texts]


def test_plan_fills_bins_gaplessly():
    rng = random.Random(0)
    for _ in range(100):
        cap = rng.choice([7, 16, 50])
        counts = {rng.randint(1, cap): rng.randint(1, 30) for _ in range(rng.randint(0, cap))}
        bins, placed = defaultdict(list), Counter()
        for length, a, b, first, offset in packing.plan(counts, cap):
            placed[length] += b - a
            for r in range(a, b):
                bins[first + r - a].append((offset, length))
        assert placed == Counter(counts) and sorted(bins) == list(range(len(bins)))
        for x in bins.values():
            at = 0
            for offset, length in sorted(x):
                assert offset == at
                at += length
            assert at <= cap


def test_plan_is_as_good_as_best_fit_decreasing():
    rng = random.Random(2)
    lengths = [min(1024, max(1, int(rng.lognormvariate(5, 1.2)))) for _ in range(3000)]
    room: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - n)
        else:
            room.append(1024 - n)
    plan = packing.plan(dict(Counter(lengths)), 1024)
    assert max(f + b - a for _, a, b, f, _ in plan) <= len(room)


@pytest.mark.parametrize("per_salt", [7, 500_000])
def test_packing_of_hot_lengths_equal_ids_and_clashing_names(spark, per_salt):
    """Half of the pieces are full, most others have one length and one id: every row has a slot of its own,
    full ones a sequence each, and the sequences are those of best-fit decreasing."""
    lengths = [1024] * 60 + [500] * 50 + [24] * 5 + [1] * 3 + [1023]
    pieces = spark.createDataFrame([(None if i % 2 else 1, n, "x", 5) for i, n in enumerate(lengths)], "doc_id long, length long, _row string, _slot int").repartition(3)
    got = packing.pack(pieces, salts=2, per_salt=per_salt)
    assert got.columns == ["doc_id", "length", "_row", "_slot", "sequence_id", "offset"]
    rows = got.collect()
    assert Counter(r["length"] for r in rows) == Counter(lengths) and {(r["_row"], r["_slot"]) for r in rows} == {("x", 5)}
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for x in by.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 1024 and (len(x) == 1 or 1024 not in [n for _, n in x])
    assert len(by) == 60 + 1 + 25


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_packing_round_trip(spark, odd_docs, which):
    docs = odd_docs if which == "odd" else spark.read.parquet(f"{SF}/documents.parquet")
    t = library()
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        want[(r["doc_id"], tuple(ids))] += 1
    pieces = packing.token_pieces(docs)
    out = packing.pack(pieces.withColumn("crc", F.crc32("ids")).withColumn("offset", F.lit("clash"))).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] <= 1024 and r["crc"] == zlib.crc32(bytes(r["ids"]))
        by_doc[r["doc_id"]].append((r["piece"], r["start"], tuple(ids)))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for x in by_sequence.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in out)
    assert len(by_sequence) <= -(-total // 1024) + max(1, total // 1024 // 50)
    for i in {k for k, _ in want}:
        own = [(ids, n) for (k, ids), n in want.items() if k == i]
        if len(own) == 1:
            ids, n = own[0]
            got = sorted(by_doc[i])
            assert [g[2] for g in got[::n]] and sum(len(g[2]) for g in got) == n * len(ids)
            whole = [x for g in got[::n] for x in g[2]]
            assert tuple(whole) == ids
            lengths = [len(g[2]) for g in got[::n]]
            assert all(x == 1024 for x in lengths[1:]) and [g[1] for g in got[::n]] == [sum(lengths[:k]) for k in range(len(lengths))]
    assert packing.pack(packing.token_pieces(docs.limit(0))).count() == 0


# -- operator 9 --

def slow_measure(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    def covered(width, later_only):
        seen, places = Counter(), defaultdict(list)
        for i in range(n - width + 1):
            places[tuple(words[i : i + width])].append(i)
        cover = set()
        for p in places.values():
            for i in (p[1:] if later_only else p if len(p) > 1 else []):
                cover.update(range(i, i + width))
        return cover
    lines, seen, dup, chars = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)], set(), 0, 0
    for x in lines:
        if x in seen:
            dup += 1
            chars += sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", x)))
        seen.add(x)
    inside = [sum(len(words[i]) for i in covered(k, True)) for k in repetition.GRAM_LIMITS]
    return (n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered(3, False)), len(lines), chars, inside)


def test_repetition_measures():
    rng = random.Random(8)
    texts = [None, "", "a", "a b c a b c", "x\nx\n \nx", "é é é é é é", "# a | b"]
    texts += ["\n".join(" ".join(rng.choice(["a", "bé", "c*", "|", "d"]) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 9))) for _ in range(200)]
    for t in texts:
        assert repetition.measure((t or "").encode()) == slow_measure(t)


def test_repetition_query(spark, odd_docs):
    for docs in (spark.read.parquet(f"{SF}/documents.parquet"), odd_docs):
        want = sorted((str(r["doc_id"]), *slow_measure(r["text"])[:5]) for r in docs.select("doc_id", "text").collect())
        out = repetition.quality_rules(docs)
        got = out.collect()
        assert sorted((str(r["doc_id"]), *(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))) for r in got) == want
        for r in got:
            assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
            over = r["n_dup_lines"] > 0.3 * r["n_lines"] or r["dup_line_chars"] > 0.2 * r["word_chars"] or any(
                r[f"dup_chars_{n}"] > limit * r["word_chars"] for n, limit in repetition.GRAM_LIMITS.items())
            assert r["kept"] == (not r["base_failed"] and not over)
    assert repetition.quality_rules(odd_docs.limit(0)).count() == 0


# -- operator 2 --

def brute_licenses(text, least):
    lines, out = text.split(b"\n"), {}
    for name, texts in TEMPLATES.items():
        for t in texts:
            grams = licenses.bigrams(licenses.words_of(t.encode()))
            for i in range(len(lines)):
                for j in range(i, len(lines)):
                    score = licenses.dice(licenses.bigrams(licenses.words_of(b"\n".join(lines[i : j + 1]))), grams)
                    if score >= least:
                        out[name] = max(out.get(name, 0), score)
    return out


def test_licence_scan_against_all_passages():
    rng, scanner = random.Random(2), licenses.Scanner(TEMPLATES, 0.8)
    vocabulary = "the of software license is a copy permission granted you may".split()
    for _ in range(25):
        lines = []
        for _ in range(rng.randint(1, 4)):
            if rng.random() < 0.6:
                words = [w for w in rng.choice(rng.choice(list(TEMPLATES.values()))).split() if rng.random() < 0.97]
                per = len(words) // rng.randint(1, 4) + 1
                lines += [" ".join(words[a : a + per]) for a in range(0, len(words), per)]
            else:
                lines.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12))))
        text = "\n".join(lines).encode()
        want = brute_licenses(text, 0.8)
        got = {m[0]: m for m in scanner.scan(text)}
        assert got.keys() == want.keys()
        for name, (_, score, first, last) in got.items():
            assert score == pytest.approx(want[name])
            passage = licenses.bigrams(licenses.words_of(b"\n".join(text.split(b"\n")[first : last + 1])))
            assert max(licenses.dice(passage, licenses.bigrams(licenses.words_of(t.encode()))) for t in TEMPLATES[name]) == pytest.approx(score)


def test_licence_scan_against_all_word_windows():
    rng = random.Random(3)
    templates = {"A": ("a b c a b d a b",), "B": ("c d e", "a a b a a"), "C": ("b c d e a b c d e a c",)}
    scanner = licenses.Scanner(templates, 0.8)
    seen = 0
    for _ in range(600):
        words = []
        while len(words) < 24 and rng.random() < 0.9:
            words += [w for w in rng.choice(rng.choice(list(templates.values()))).split() if rng.random() < 0.9] if rng.random() < 0.5 else [rng.choice("abcdexy")]
        text = "".join(w + rng.choice([" ", " ", ". ", "\n", "\r", "\n\n"]) for w in words).encode()
        ends, want = [len(licenses.words_of(x)) for x in text.split(b"\n")], {}
        line = [n for n, many in enumerate(ends) for _ in range(many)]
        words = licenses.words_of(text)
        for name, texts in templates.items():
            all_of = [(-licenses.dice(licenses.bigrams(words[i:j]), licenses.bigrams(licenses.words_of(t.encode()))), i, j) for t in texts
                      for i in range(len(words)) for j in range(i + 2, len(words) + 1)]
            if all_of and min(all_of)[0] <= -0.8:
                score, i, j = min(all_of)
                want[name] = (-score, line[i], line[j - 1])
        assert {m[0]: m[1:] for m in scanner.passages(text)} == want
        seen += len(want)
    assert seen > 300


def test_notices_that_share_a_line(spark):
    mit = " ".join(TEMPLATES["MIT"][0].split())
    prose = "some words of another kind that go on and on " * 60
    texts = ["Copyright 2020 Jane Doe. Released under the MIT License. All rights reserved.", f"{prose}{mit} {prose}", f"{prose}\r{mit}\r{prose}",
             f"{prose}\nx {mit[:300]}\n{mit[300:]} y\n{prose}"]
    out = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [(out[i]["license"], out[i]["dice"] > 0.98) for i in range(4)] == [("MIT", True)] * 4
    assert [(m["first_line"], m["last_line"]) for m in out[3]["matches"]] == [(1, 2)]


def test_licence_query(spark, odd_docs):
    extra = spark.createDataFrame([(50, "Some prose.\nReleased under the MIT license\nmore"), (51, TEMPLATES["ISC"][0].replace(" ", "\n", 20)), (52, "MIT License")],
                                  "doc_id long, text string")
    out = {r["doc_id"]: r for r in licenses.scan_licenses(odd_docs.select("doc_id", "text").unionByName(extra)).collect()}
    assert (out[50]["license"], out[50]["dice"], out[50]["matches"][0]["first_line"], out[50]["n_licenses"]) == ("MIT", 1.0, 1, 1)
    assert out[51]["license"] == "ISC" and out[51]["dice"] == 1.0
    assert all(out[i]["license"] is None and out[i]["n_licenses"] == 0 for i in (1, 4, 5, 7, 10, 52))
    assert licenses.scan_licenses(odd_docs).count() == odd_docs.count() and licenses.scan_licenses(odd_docs.limit(0)).count() == 0


# -- operator 7 --

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>"; if (a < b) {}</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad">Buy</div>
<article><header><h1>Ti&eacute;tle &amp; more</h1></header><p>First <b>bold</b>
 text.<br>next<p>Short.</p><aside>side</aside><ul><li>one</li><li>two</li></ul><p data-x="a>b">Last&nbsp;one</p><form><input value="x">Name</form></article>
<section id="comments"><p>I was here, and I have a lot to say about this article, really a lot of words.</p></section><footer>&copy; us</footer>"""


def test_page_text():
    assert html_text.main_blocks(PAGE) == ["Tiétle & more", "First bold text. next", "Short.", "one", "two", "Last one"]
    assert html_text.main_blocks("") == [] and html_text.main_blocks("<p>only <i>this</i>") == ["only this"]
    assert html_text.main_blocks("no markup &lt;at all&gt;") == ["no markup <at all>"]


def test_page_without_a_marked_article():
    long = "Words that make up a paragraph of the article, enough of them to make the distribution surge here."
    page = f'<div class="menu">Home</div><div><a href=1>Home</a> <a href=2>About us</a></div><hr><div></div><div><h2>Head</h2><p>{long}</p><p>Short.</p><p>{long}</p></div><div class="footer">c</div>'
    assert html_text.main_blocks(page) == ["Head", long, "Short.", long]


@pytest.mark.parametrize("attributes", ['style="overflow:hidden"', "style='overflow: hidden'", "style=overflow:hidden", 'data-hidden="false"', 'data-class="nav"', 'data-id=menu',
                                        'title="class=menu"', 'aria-hidden="false"', 'href="/x?id=search"', 'href=/hidden-gems', 'onclick="a(\'id=nav\')"', 'data-x="hidden'])
def test_attributes_are_whole_names(attributes):
    for name in ("div", "a"):
        assert html_text.main_blocks(f"<p>Before</p><p><b>Some</b> <{name} {attributes}>kept words</{name}> and more</p>") != ["Before", "Some and more"]
        assert "kept words" in " ".join(html_text.main_blocks(f"<article><p>Some</p><{name} {attributes}>kept words</{name}></article>"))


@pytest.mark.parametrize("attributes", ["hidden", 'HIDDEN=""', "hidden=hidden", 'aria-hidden = "true"', 'data-x="1"class="nav"', "id='menu'", "role=search", 'title="a>b" hidden'])
def test_attributes_that_leave_out(attributes):
    assert html_text.main_blocks(f"<article><p>Some words of an article</p><div {attributes}>gone</div></article>") == ["Some words of an article"]


TEXT = "Words that make up a paragraph of the article, enough of them to make the distribution surge here."


@pytest.mark.parametrize("page", [
    '<div class="row has-sidebar"><div>{}</div></div>', '<div class="post no-comments">{}</div>', '<article class="post tag-social">{}</article>',
    "<form><div class=x>{}</div><input></form>", "<form><nav><a href=1>Menu</a></nav><article>{}</article></form>", '<div class="widget"><main>{}</main></div>',
    '<div class="sidebar"><article>{}</article></div>', '<div class="banner">{}</div><p>Hi</p>', '<div id="comments">{}</div>', "<header><div>{}</div></header>",
    '<form><article class="social">{}</article></form><div class="menu">Home</div>', '<div class="widget"><div role="main">{}</div></div>',
    '<div class=share>Share<p>{}</div>', '<ul><li class="share">Share<li>{}</ul>'])
def test_what_holds_the_article_stays(page):
    assert TEXT in html_text.main_blocks(page.format(f"<p>{TEXT}</p>"))


def test_a_teaser_is_not_the_page():
    page = f"<article><p>A teaser.</p></article><div><p>{TEXT}</p><p>{TEXT} More.</p></div><div class='site-footer'><p>{TEXT} Footer.</p></div>"
    assert html_text.main_blocks(page) == ["A teaser.", TEXT, f"{TEXT} More."]
    beside = f"<div class='sidebar'><article>A teaser.</article></div><div><p>{TEXT}</p></div>"
    assert html_text.main_blocks(beside) == [TEXT]
    advert = f"<div class='ad'><p>{TEXT}</p></div><article><p>Short.</p></article>"
    assert html_text.main_blocks(advert) == ["Short."]
    thick = f"<article><p>{TEXT}</p><p>{TEXT}</p></article><hr><hr><div><p>{TEXT} Not the article.</p></div>"
    assert html_text.main_blocks(thick) == [TEXT, TEXT]


@pytest.mark.parametrize("value", ["main-nav", "site-footer", "comment-list", "ad-300x250", "sidebar1", "x menu"])
def test_marked_tokens(value):
    assert html_text.main_blocks(f"<article><p>{TEXT}</p><p>Short.</p><div class='{value}'>gone</div></article>") == [TEXT, "Short."]


def test_formulas_stay():
    page = "<article><p>Let <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x=2</annotation></semantics></math> be.</p></article>"
    assert html_text.main_blocks(page) == ["Let x=2 be."]


@pytest.mark.parametrize("page", ["<", "<p", "<p class='", "</", "<!--", "<!-- x", "<script>x", "<a href=\"x>y</a>", "&#xD800; &bogus; &amp", "<nav>x", "<div hidden>a</div>b", "<p/><br/>" * 50])
def test_broken_pages(page):
    assert isinstance(html_text.main_blocks(page), list)


def test_page_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = {r["page_id"]: r for r in html_text.extract_main_text(pages).collect()}
    import html

    for r in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|<footer>|$)", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1|ul|li)>", inside.replace("<br>", " "))
        want = [x for x in (" ".join(html.unescape(re.sub(r"</?[ab][^>]*>", "", p)).split()) for p in parts) if x]
        assert out[r["page_id"]]["text"] == "\n\n".join(want) and out[r["page_id"]]["n_chars"] == len("\n\n".join(want))
    odd = spark.createDataFrame([(None, None, None, "x"), (1, "u", "", "x"), (1, "u", PAGE, "x")], "page_id long, url string, html string, text string")
    got = html_text.extract_main_text(odd).collect()
    assert [r["n_chars"] for r in got if r["page_id"] is None] == [0] and len(got) == 3
    assert html_text.extract_main_text(odd.limit(0)).count() == 0


def test_sentences_around_links_and_compound_names_of_parts():
    """Without an article element: a paragraph that is mostly a link is text, a list of links is not. Comments,
    adverts and calls to sign up go by every word of their name, also inside an article."""
    from fleetlake.llm.html_text import main_blocks

    first = "The committee met in the town hall on Monday and heard all of the reports that had been asked for in spring."
    linked = "Its members read <a href='/r'>the long report on the state of the old bridge and the road that leads to it</a> aloud."
    page = f"<html><body><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul><p>{first}</p><p>{linked}</p><p>{first}</p><p>See also: <a href='/x'>another story of the same week and place</a></p></body></html>"
    assert main_blocks(page) == [first, linked.replace("<a href='/r'>", "").replace("</a>", ""), first]
    for name in ("reader-responses", "user-comments", "promo-box-wide", "newsletter-cta", "responses"):
        page = f"<html><body><article><p>{first}</p><div class='{name}'><p>Buy now and write to us, as so many others have done before you.</p></div><p>{first}</p></article></body></html>"
        assert main_blocks(page) == [first, first], name
    for name in ("wide", "reader-view", "user-story", "large-text", "discussion"):  # not parts by their name
        page = f"<html><body><article><div class='{name}'><p>{first}</p></div><p>{first}</p></article></body></html>"
        assert main_blocks(page) == [first, first], name
