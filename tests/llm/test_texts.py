"""Language identification, SentencePiece and page extraction."""

import html
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from rows import clashing, ordered
from sentencepiece import sentencepiece_model_pb2 as form

import __spark_entry__ as entry
from riskspark.llm import language_id, main_text, pieces
from riskspark.llm.base import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a  b ", "▁▁a", "a▁ b", "\n x\n", "😀 é\t", "a\0b", "x" * 3000, "日本語 テスト", "　  ", "a" * 70000 + " b"]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, "/root/testdata/sf0.01", "documents")


@pytest.fixture(scope="module")
def net(docs):
    return language_id.learn(docs)


def test_language_of_the_held_out_fold(docs, net):
    said = language_id.identify(docs, net).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in said)
    assert len(said) > 150 and right / len(said) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in said)


def test_held_out_is_the_remainder_of_the_checksum(docs, net):
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in language_id.identify(docs, net).collect())


def test_tables_equal_the_network(net):
    x = np.random.default_rng(1).integers(0, 256, (50, language_id.WINDOW)).astype(np.uint8)
    pooled, _ = net._pooled(x)
    want = language_id.softmax(np.maximum(pooled, 0) @ net.out + net.shift)
    assert np.allclose(net.compiled().probabilities(x), want, atol=1e-4)


def test_gradients_by_differences():
    r = np.random.default_rng(3)
    net = language_id.Network(["a", "b", "c"], filters=3, depth=4)
    x, y = r.integers(0, 6, (5, 20)).astype(np.uint8), np.array([0, 1, 2, 0, 1])
    _, grads = net.gradients(x, y)
    for p, g in zip(net.parameters(), grads):
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, eps = p[i], 1e-6
        p[i] = old + eps
        up = net.gradients(x, y)[0]
        p[i] = old - eps
        down = net.gradients(x, y)[0]
        p[i] = old
        assert abs((up - down) / (2 * eps) - g[i]) < 1e-4


def test_windows_hold_every_position_of_the_widest_filter():
    for n in (0, 1, 3, 191, 192, 193, 381, 382, 1000):
        text = bytes(np.random.default_rng(n).integers(1, 256, n).astype(np.uint8))
        w, weight = language_id.windows(text)
        grams = {bytes(r[i : i + 4]) for r in w for i in range(language_id.WINDOW - 3)}
        assert all(text[i : i + 4] in grams for i in range(n - 3)) and weight.sum() == max(1, n)


def test_language_of_odd_texts(spark, net):
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (None, "the of and"), (5, "the of and"), (5, "the of and"), (6, "é")]
    got = {(r["doc_id"], r["lang_pred"] == "und", r["held_out"]) for r in language_id.identify(clashing(spark, rows), net).collect()}
    assert {(1, True, False), (2, True, False), (3, True, False), (None, False, True)} <= {(a, b, c if a is None else False) for a, b, c in got}
    df = clashing(spark, rows)
    kept = language_id.accepted(df, net)
    assert kept.columns == df.columns and kept.count() == 4


def test_language_without_labels(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert language_id.learn(df) is None
    assert [tuple(r)[2:] for r in language_id.identify(df, None).collect()] == [("und", 0.0)]
    assert language_id.learn(df.limit(0)) is None and language_id.identify(df.limit(0), None).count() == 0


def test_accepted_without_a_network_keeps_texts_with_letters(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, "12 !", None), (3, None, None), (None, "é", None)], "doc_id long, text string, lang string")
    kept = language_id.accepted(df, language_id.learn(df))
    assert kept.columns == df.columns and sorted(r["text"] for r in kept.collect()) == ["some text", "é"]


def test_least_score_follows_chance():
    assert language_id.least_score(4) == 0.3 and language_id.least_score(1) == 0
    assert all(1 / n < language_id.least_score(n) < 1 / n + 0.07 for n in (2, 3, 10, 100))


def test_sample_is_bounded_where_one_id_holds_a_third(spark, monkeypatch):
    """One id with a hundred texts, and a hundred copies of one row: each gives no more than its share of distinct rows."""
    import zlib

    mine = next(k for k in range(1000) if zlib.crc32(str(k).encode()) % 5)
    rows = [(mine, f"text number {i}", "a") for i in range(300)] + [(mine, "copy of a row", "b")] * 100 + [(i, f"words {i}", "b") for i in range(100)]
    seen = []
    monkeypatch.setattr(language_id.Network, "fit", lambda self, x, y: seen.append((x, y)) or self)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    collected = []
    frame = type(df)
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: collected.append(collect(self)) or collected[-1])
    assert language_id.learn(df, rows=40, pieces=1).labels == ["a", "b"]
    x, y = seen[0]
    assert np.bincount(y).tolist() == [20, 20] and len(np.unique(x, axis=0)) == 40
    assert max(map(len, collected)) <= 40


def test_pieces_equal_the_library(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + list(enumerate(ODD)) + [(None, None), (None, "x y")]
    for k, ids, begin, end, decoded in ordered(pieces.encode_documents(clashing(spark, rows), MODEL)):
        assert ids[-1] == library.eos_id() and begin[-1] == end[-1]
        assert decoded == library.decode(ids)
    own = pieces.Model(pieces.read_model(MODEL))
    texts = [t or "" for _, t in rows]
    ids, begin, end, at = own.encode([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == library.encode(t, add_eos=True)
        spans = [(p.begin, p.end) for p in library.encode(t, return_type="proto").pieces]
        assert list(zip(begin[at[i] : at[i + 1]].tolist(), end[at[i] : at[i + 1]].tolist()))[:-1] == spans
    assert own.decode(ids, at) == [library.decode(library.encode(t)) for t in texts]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
def test_pieces_through_a_character_map(rule):
    proto = form.ModelProto()
    proto.ParseFromString(pieces.read_model(MODEL))
    spec = form.NormalizerSpec()
    spec.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec())
    proto.normalizer_spec.precompiled_charsmap = spec.precompiled_charsmap
    proto.normalizer_spec.remove_extra_whitespaces = True
    blob = proto.SerializeToString()
    library, own = sentencepiece.SentencePieceProcessor(model_proto=blob), pieces.Model(blob)
    texts = ["  Ａｂｃ  １２３ ﬁ  ½ ", "Ⅷ é é ㌔ 株式会社 ㈱", "a b\tc\r\nd​ e", "", "  ", "ｱｲｳ ﾊﾟ", "plain words"]
    ids, begin, end, at = own.encode([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == library.encode(t, add_eos=True)
        spans = [(p.begin, p.end) for p in library.encode(t, return_type="proto").pieces]
        assert list(zip(begin[at[i] : at[i + 1]].tolist(), end[at[i] : at[i + 1]].tolist()))[:-1] == spans
    assert own.decode(ids, at) == [library.decode(library.encode(t)) for t in texts]


def test_piece_cache_can_be_small(monkeypatch):
    monkeypatch.setattr(pieces.Model, "CACHE", 2)
    own, library = pieces.Model(pieces.read_model(MODEL)), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for t in ("one two three four", "five one six", ""):
        assert own.encode([t.encode()])[0].tolist() == library.encode(t, add_eos=True)


def test_piece_digests(spark):
    import hashlib

    df = spark.createDataFrame([(1, None), (2, "Hi there"), (2, "Hi there")], "doc_id long, text string")
    got = ordered(pieces.digests(pieces.encode_documents(df, MODEL)))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = []
    for k, t in ((1, ""), (2, "Hi there"), (2, "Hi there")):
        ids = library.encode(t, add_eos=True)
        want.append((k, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert got == want
    assert pieces.encode_documents(df.limit(0), MODEL).count() == 0


PAGE = """<html><head><title>T &amp; x</title><style>p{}</style></head><body class="home page"><div id="cookie-banner">We use cookies. <button>OK</button></div>
<header class="site-header"><h2>My Site</h2><p>The best site of all sites with a long line that reads like a sentence.</p></header>
<div class="menu"><ul><li><a href=/>Home</a><li><a href=/a>About us</a></ul></div>
<div id="content"><h1>Real   Title</h1><p>First para with <a href=x>a link</a> and more text, which goes on for a while.<p>Second&nbsp;para &lt;b&gt; here.<br>next line
<ul><li>point one</li><li>point two</li></ul><div class="ad-slot">Buy now the best product in the world, only today!</div><p>Third.</p>
<script>var a = "<p>no</p>";</script></div><aside><p>Side story that is long enough to look like a paragraph of text. Really long.</p></aside>
<form><label>Your mail</label><input><button>Subscribe</button></form>
<section id="comments"><h3>2 comments</h3><div class="comment"><p>I totally agree with this article, thanks for writing it.</p></div></section>
<div class="notice">Notice: this page was moved to a new place, please change your bookmarks.</div><footer>&copy; 2024 Me</footer></body></html>"""


def test_page_without_its_surroundings():
    assert main_text.extract(PAGE) == (
        "Real Title\nFirst para with a link and more text, which goes on for a while.\nSecond para <b> here. next line\npoint one\npoint two\nThird."
    )


@pytest.mark.parametrize("page,text", [
    ("", ""), ("<!-- only", ""), ("just text, no tags", "just text, no tags"), ("<article><p>x &am", "x &am"), ("<article><p>a < b and c > d</p>", "a < b and c > d"),
    ("<article><h1>A b</h1><p>Some text <a hre", "A b\nSome text"), ('<article><p title="a > b">inside</p>', "inside"),
    ("<article><p>Main story text is here.</p><div class=comments><p>reader says hi there, a long text it is.</p></div></article>", "Main story text is here."),
    ("<nav><a href=x>Home</a></nav><script>x", ""), ("<article><p>one" + " two" * 30000, "one" + " two" * 30000),
])
def test_odd_pages(page, text):
    assert main_text.extract(page) == text


LONG = "The tenant may end the contract with three months of notice, " * 5 + "as the law says."


@pytest.mark.parametrize("page,text", [
    ('<article><h2 id="related-work">Related work</h2><p>Others did this before.</p></article>', "Related work\nOthers did this before."),
    ('<article><p>First.</p><section id="notice-period"><p>Three months.</p></section><section id="search"><p>How to search.</p></section></article>', "First.\nThree months.\nHow to search."),
    ('<div id="content" class="has-sidebar"><p>A page in a frame of two columns.</p></div>', "A page in a frame of two columns."),
    (f'<div class="widget"><p>{LONG}</p></div>', LONG), (f'<article><div class="notice"><p>{LONG}</p></div></article>', LONG),
    ('<article><p>Main story text is here.</p><div class="sidebar"><p>Read our other story too.</p></div></article>', "Main story text is here."),
    ('<article class="post has-comments"><p>Main story text is here.</p></article><article class="comment"><p>I like this story a lot.</p></article>', "Main story text is here."),
    ("<article><p>Before the drawing.</p><svg><p>After it comes more.</p></article>", "Before the drawing.\nAfter it comes more."),
    ("<article><p>Before the code.</p><script>var x = 1; <p>After it.</p>", "Before the code."),
])
def test_names_are_evidence_that_text_can_outweigh(page, text):
    assert main_text.extract(page) == text


def test_pages_of_the_table(spark):
    pages = {r["page_id"]: r for r in table(spark, "/root/testdata/sf0.001", "pages").collect()}
    got = entry.queries()["op5_main_text"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(pages)
    for r in got:
        page = pages[r["page_id"]]["html"] or ""
        inner = re.sub(r"<[^>]*\Z", "", page.partition("<article>")[2].partition("</article>")[0])
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in re.split(r"</?p>|</?h1>", inner)]
        assert r["text"] == "\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


def test_page_rows(spark):
    df = spark.createDataFrame([(1, None, None, "k"), (None, "u", PAGE, "k"), (2, "u", "", "k"), (2, "u", "", "k")], "page_id long, url string, html string, text string")
    assert sorted((r["page_id"] or 0, r["n_chars"] > 0) for r in main_text.extract_pages(df).collect()) == [(0, True), (1, False), (2, False), (2, False)]
    assert main_text.extract_pages(df.limit(0)).count() == 0


def test_cut_is_the_cheapest_labelling():
    import itertools
    import random

    r = random.Random(2)
    for _ in range(30):
        n = r.randrange(1, 8)
        found = [main_text.Block("w" * 5, 0, "p", (1, r.randrange(2, 4), 10 + i), r.uniform(-4, 2)) for i in range(n)]
        edges, last = [], {}
        for i, b in enumerate(found):
            for j in {x for x in (i - 1, last.get(b.path[-2])) if x is not None and x >= 0}:
                edges.append((j, i, round(100 * main_text._affinity(found[j], b))))
            last[b.path[-2]] = i
        costs = [round(100 * main_text.log_odds(b)) for b in found]

        def cost(keep):
            return sum(-c if k else c for c, k in zip(costs, keep)) / 2 + sum(w for a, b, w in edges if keep[a] != keep[b])

        assert cost(main_text.label(found)) == min(map(cost, itertools.product([False, True], repeat=n)))
