"""Language, HTML, tokens and language-model scores against plain Python and the tokenizers library."""

import collections
import html as entities
import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cairn.llm import bpe, html, language, lm
from cairn.llm.queries import VOCABULARY


def python_costs(samples, text, order=3):
    """Code length of a text by method C, from counts kept in dictionaries."""
    counts = collections.defaultdict(collections.Counter)
    for some in samples:
        raw = b"\n\n\n" + some.encode()
        for i in range(3, len(raw)):
            for k in range(order + 1):
                counts[raw[i - k:i]][raw[i]] += 1
    bits, raw = 0.0, b"\n\n\n" + text.encode()
    for i in range(3, len(raw)):
        for k in range(order, -1, -1):
            seen = counts.get(raw[i - k:i])
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if raw[i] in seen:
                bits -= math.log2(seen[raw[i]] / total)
                break
            bits -= math.log2(len(seen) / total)
        else:
            bits += 8
    return bits


SAMPLES = {"de": ["der die und nicht", "über die straße gehen"], "en": ["the and of them", "this is that"]}


def test_code_lengths_are_exact(spark):
    docs = spark.createDataFrame([(t, k) for k, some in SAMPLES.items() for t in some], "text string, lang string")
    model = language.learn(docs)
    texts = ["the street", "über nicht", "日本", "", None, "x" * 40]
    got = language.text_costs(model, pa.array(texts))
    for row, text in zip(got, texts, strict=True):
        for k, name in enumerate(model.languages):
            assert row[k] == pytest.approx(python_costs(SAMPLES[name], text or ""), rel=1e-5)


def test_pieces_do_not_change_code_lengths(spark, monkeypatch):
    docs = spark.createDataFrame([(t, k) for k, some in SAMPLES.items() for t in some], "text string, lang string")
    model = language.learn(docs)
    texts = pa.array(["the street and the house " * 300, "", "die straße " * 200])
    whole = language.text_costs(model, texts)
    monkeypatch.setattr(language, "_PIECE", 1)
    assert np.allclose(whole, language.text_costs(model, texts))


def test_no_language_is_left_out(spark):
    rows = [(f"w{k:03d} own{k * 7919} words", f"l{k:03d}") for k in range(300)] + [("of many documents", "big")] * 50
    model = language.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == sorted({lang for _, lang in rows})
    got = language.text_costs(model, pa.array([rows[299][0]]))
    assert model.languages[got[0].argmin()] == "l299"


def test_copies_neither_hide_a_language_nor_fill_its_sample(spark):
    rows = [("der die und nicht über die straße", "de")] * 3000 + [(f"the and of them number {k}", "en") for k in range(200)]
    rows += [("el perro y la casa", "es")] * 3000 + [(f"los libros de la casa {k} son", "es") for k in range(900)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    for sample in (1, 5, 300):
        assert "de" in language.learn(docs, sample=sample).languages
    model = language.learn(docs, sample=300)
    assert model.languages == ["de", "en", "es"]
    names = [model.languages[k] for k in language.text_costs(model, pa.array(["die straße nicht", "them and the", "los libros y"])).argmin(axis=1)]
    assert names == ["de", "en", "es"]
    # The sample is bounded by texts: a copied one is one of them.
    held = language.learn(spark.createDataFrame([("aaaa", "x")] * 5000 + [("bbbb", "x")], "text string, lang string"), sample=2)
    costs = language.text_costs(held, pa.array(["aaaa", "bbbb"]))[:, 0]
    assert costs[0] == pytest.approx(costs[1])


def test_identify(odd, none):
    model = language.learn(odd)
    got = language.identify(odd, model)
    assert [c for c in got.columns if c not in ("lang_pred", "score", "bits_per_byte")] == [c for c in odd.columns if c != "score"]
    for r in got.collect():
        letters = bool(re.search(r"[^\W\d_]", r["text"] or ""))
        assert (r["lang_pred"] in ("en", "de")) == letters and 0 <= r["score"] <= 1
    assert language.learn(none) is None and language.identify(none, model).count() == 0
    assert {r["lang_pred"] for r in language.identify(odd, None).collect()} == {"und"}


FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.withColumn("held_out", language.held_out(F.col("doc_id")))
    got = language.identify(rows.where("held_out"), language.learn(rows.where("NOT held_out"))).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)


PAGES = [
    ("<html><head><title>no</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li>no</ul></nav>"
     "<!-- no --><div class='ad'>no<div>no</div></div><article><h1>A &amp; B</h1><p><b>one.<br><p>two\n  three&nbsp;four"
     "</p><aside>no</aside><p>five</p><div id=\"comments\"><p>no</p></div></article><footer>no</footer>", "A & B one. two three four five"),
    ("<body><header>no</header><main><p class=advert>no<p>yes<form>no</form>tail</main><div class='cookie-notice'>no</div>", "yes tail"),
    ("<div class='site-header'>no</div><div class='with-sidebar'><p>" + "long text " * 20 + "</p></div>", ("long text " * 20).strip()),
    ("just text &lt;b&gt; &#233;", "just text <b> é"), ("", ""), (None, ""), ("<article></article>", ""),
    ("<article>a<span>b</span>c<script>no", "abc"), ("<article>x &am</article>", "x &am"), ("a < b and c > d", "a < b and c > d"),
]


def test_pages(spark):
    rows = [(k, f"u{k}", page, "old") for k, (page, _) in enumerate(PAGES)] * 2
    got = html.extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "text"]
    for r in got.collect():
        assert r["text"] == PAGES[r["page_id"]][1], PAGES[r["page_id"]]
    assert html.extract_pages(spark.createDataFrame([], "page_id bigint, html string")).count() == 0


def test_lines_without_marks_surge_and_dive():
    menu = "".join(f"<p>m{k}</p>" for k in range(5))
    page = menu + "<div class=menu>x</div>" + "<p>" + "words of the text " * 12 + "</p><p>short</p><nav>x</nav>" + menu
    assert html.main_text(page) == ("words of the text " * 12).strip() + " short"


def test_a_marked_article_does_not_hide_the_story():
    story = "words of the story " * 12
    card = "<article><h3>card</h3></article>"
    page = f"<div><p>{story}</p><p>short</p><p>{story}</p></div>{card}{card}"
    assert html.main_text(page) == f"{story}short {story}card card"
    links = "".join(f"<p><a href=/{k}>a link of some length to page {k}</a></p>" for k in range(9))
    assert html.main_text(f"{links}<article><p>yes</p><p>{story}</p></article>{links}") == "yes " + story.strip()


def test_unmarked_text_ends_before_short_lines_and_links():
    story = "words of the story " * 12
    menu = "".join(f"<p>m{k}</p>" for k in range(6))
    links = "".join(f"<p><a href=/{k}>a link of some length to page {k}</a></p>" for k in range(9))
    page = f"{links}<p>{story}</p><p>Yes.</p><p>No.</p><p>Why?</p><p>So.</p><p>{story}</p>"
    assert html.main_text(page + menu) == html.main_text(page + links) == f"{story}Yes. No. Why? So. {story.strip()}"


@pytest.mark.parametrize("attributes", ["style='overflow:hidden'", "class=overflow-hidden", "data-id=menu", "id=related-work",
                                        "id='search-algorithms'", "class=social-history", "hidden=until-found", "title='is hidden'"])
def test_what_is_only_named_like_junk_stays(attributes):
    assert html.main_text(f"<article><p>one</p><div {attributes}>two</div></article>") == "one two"
    assert html.main_text(f"<div {attributes.replace('id=related-work', 'id=work').replace('search-', '').replace('social-', '')}>"
                          f"<article>one</article></div>") == "one"


@pytest.mark.parametrize("attributes", ["hidden", "hidden=''", "aria-hidden=true", "style='color:red; display: none'",
                                        "style=visibility:hidden", "id=comments", "class='a share-buttons'"])
def test_what_is_hidden_or_junk_goes(attributes):
    assert html.main_text(f"<article><p>one</p><div {attributes}>two</div></article>") == "one"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_articles_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    want = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        want[r["page_id"]] = " ".join(" ".join(entities.unescape(p) for p in re.split(r"<[^>]*>", article)).split())
    assert {r["page_id"]: r["text"] for r in html.extract_pages(pages).collect()} == want


@pytest.fixture(scope="module")
def vocabulary():
    if not os.path.exists(VOCABULARY):
        pytest.skip("no vocabulary")
    with open(VOCABULARY, encoding="utf-8") as file:
        return file.read()


def odd_texts():
    rnd = random.Random(1)
    yield from ["", "<|endoftext|>a<|endoftext|> <|endoftext", "\x1c\x1d a \x85b  c", "aaaa" * 400, "é" * 700, "日本語のテキスト です。" * 30,
                "  \n\n  x\t\t y 's 'S don't we'll", "😀👍🏽 ½ ²³ Ⅷ٣", "x" * 3000, " " * 1000 + "a", "ab" * 600]
    for _ in range(200):
        yield "".join(rnd.choice("ab \n'sté日1.# \x00\x7f​　") for _ in range(rnd.randint(0, 200)))


def test_ids_equal_the_library(vocabulary):
    tokenizers = pytest.importorskip("tokenizers")
    library, own = tokenizers.Tokenizer.from_str(vocabulary), bpe.Tokenizer(vocabulary)
    texts = list(odd_texts())
    for text, ids in zip(texts, own.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False) == text
    assert own.decode(np.array([0xE9 % 50, 188])) == library.decode([0xE9 % 50, 188], skip_special_tokens=False)


def test_a_cleared_cache_changes_nothing(vocabulary, monkeypatch):
    own = bpe.Tokenizer(vocabulary)
    texts = list(odd_texts())
    before = [i.tolist() for i in own.encode(texts)]
    monkeypatch.setattr(bpe, "CACHE_BYTES", 0)
    assert [own.encode([t])[0].tolist() for t in texts] == before


def test_round_trip(odd, none, vocabulary):
    got = bpe.encode_documents(odd, vocabulary, decoded=True)
    assert got.columns == [c for c in odd.columns if c != "ids"] + ["ids", "decoded"]
    rows = got.collect()
    assert len(rows) == odd.count() and all(r["decoded"] == (r["text"] or "") for r in rows)
    assert bpe.encode_documents(none, vocabulary).count() == 0


def python_tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())), "end"]


def python_base(train, rows):
    counts = collections.Counter(t for text in train for t in python_tokens(text))
    total, size = sum(counts.values()), len(counts)
    for text in rows:
        some = python_tokens(text)
        yield (len(some), sum(counts[t] > 0 for t in some),
               sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (size + 1))) for t in some))


@pytest.mark.parametrize("head", [3, 1 << 17])
def test_base_scores(odd, odd_rows, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)
    train = odd.withColumn("held", language.held_out(F.col("doc_id"), 10)).where("NOT held")
    got = lm.score_documents(odd, lm.learn(train)).collect()
    learned = [r[1] for r in odd_rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10]
    want = sorted((r[0] is None, r[0] or 0, *b) for r, b in zip(odd_rows, python_base(learned, [r[1] for r in odd_rows]), strict=True))
    have = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["base_score"]) for r in got)
    for a, b in zip(want, have, strict=True):
        assert a[:4] == b[:4] and b[4] == pytest.approx(a[4], abs=1e-8)
    assert all(r["score"] < 0 for r in got)


def test_filter_counts(odd):
    found = lm.learn(odd).filter
    texts = pa.array([r["text"] for r in odd.collect()])
    some = lm.tokens(texts)
    keys, n = np.unique(some.hashes, return_counts=True)
    levels = found.levels(keys)
    true = np.floor(np.log2(n)).astype(int) + 1
    assert (levels >= true).all() and (levels == true).mean() > 0.9
    assert (found.levels(np.arange(1, 4000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) == 0).mean() > 0.9


def test_scores_prefer_known_order(spark):
    text = "the cat sat on the mat and the dog lay on the rug"
    train = spark.createDataFrame([(k, text) for k in range(20)], "doc_id bigint, text string")
    shuffled = " ".join(sorted(text.split(" ")))
    asked = spark.createDataFrame([(1, text), (2, shuffled), (3, "zz yy xx ww vv uu tt ss rr qq pp oo")], "doc_id bigint, text string")
    score = {r["doc_id"]: r["score"] for r in lm.score_documents(asked, lm.learn(train)).collect()}
    assert score[1] > score[2] > score[3]


def test_pairs_seen_once_are_stored(spark):
    docs = spark.createDataFrame([(1, "one two three")], "doc_id bigint, text string")
    found = lm.learn(docs).filter
    assert (found.levels(lm.pair_hashes(lm.tokens(pa.array(["one two three"])))) >= 1).all()


def python_scores(train, rows):
    """Smoothed pair probabilities from quantised counts, kept in dictionaries."""
    words, pairs, total = collections.Counter(), collections.Counter(), 0
    for text in train:
        some = python_tokens(text)
        words.update(some)
        pairs.update(zip(["start", *some], some))
        total += len(some)

    def quantised(n):
        q = int(math.log2(n) + 1e-9) + 1 if n else 0
        return q if q < 2 else 1.5 * 2 ** (q - 1) - 0.5

    for text in rows:
        some, score = python_tokens(text), 0.0
        for before, word in zip(["start", *some], some):
            alone = (quantised(words[word]) + 0.1) / (total + 0.1 * (len(words) + 1))
            both = quantised(pairs[before, word])
            first = max(1.0, quantised(words["end"])) if before == "start" else quantised(words[before])
            score += math.log10(min(1.0, (both + lm.PRIOR * alone) / (max(first, both) + lm.PRIOR)))
        yield score


@pytest.mark.parametrize("sent", [lm.SENT, 0])
def test_scores_equal_those_of_counts_in_dictionaries(spark, odd, odd_rows, monkeypatch, sent):
    monkeypatch.setattr(lm, "BITS", 200)  # no sequence is found by chance
    monkeypatch.setattr(lm, "SENT", sent)
    monkeypatch.setattr(lm, "SHARE", 3000)
    monkeypatch.setattr(lm, "BUCKET", 2000)
    texts = [r[1] for r in odd_rows] + ["one two"] * 40
    train = spark.createDataFrame([(t,) for t in texts[:7] + texts[9:]], "text string")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in lm.score_documents(odd, lm.learn(train)).collect())
    want = sorted((r[0] is None, r[0] or 0, x) for r, x in zip(odd_rows, python_scores(texts[:7] + texts[9:], [r[1] for r in odd_rows]), strict=True))
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert [x[2] for x in got] == pytest.approx([x[2] for x in want], abs=1e-8)


def test_packed_hashes():
    rnd = np.random.default_rng(3)
    for keys in ([], [7], [0, 2 ** 64 - 1], [5, 6, 7], rnd.integers(0, 2 ** 64, 1000, np.uint64), [3, 3 + 2 ** 40, 9 + 2 ** 40]):
        keys = np.unique(np.array(keys, np.uint64))
        assert (lm.unpack(lm.pack(keys)) == keys).all()
    assert len(lm.pack(np.arange(10, 1000, dtype=np.uint64))) == 9 + 989


def test_scores_do_not_depend_on_where_the_filter_is(spark, monkeypatch):
    texts = [" ".join(f"w{k * i % 50021}" for k in range(1, 3000)) for i in range(1, 26)] + ["", None, "w1 w2 w1 w2", "w1 w2 w1 w2"]
    docs = spark.createDataFrame([(min(i, 27), t) for i, t in enumerate(texts)], "doc_id bigint, text string")

    def scores():
        model = lm.learn(docs)
        return model.table, sorted(tuple(r) for r in lm.score_documents(docs, model).collect())

    table, sent = scores()
    monkeypatch.setattr(lm, "SENT", 0)
    monkeypatch.setattr(lm, "BUCKET", 100_000)
    assert table is None
    table, asked = scores()
    assert table is not None and len(asked) == len(texts)
    for a, b in zip(sent, asked, strict=True):
        assert a == pytest.approx(b, abs=1e-9)


def test_empty_scores(odd, none):
    assert lm.score_documents(none, lm.learn(none)).count() == 0
    assert lm.score_documents(odd, lm.learn(none)).count() == odd.count()


def test_a_frequent_sequence_is_asked_once(monkeypatch):
    asked, plain = [], lm._bits_of
    monkeypatch.setattr(lm, "_bits_of", lambda h, level, size: asked.append(len(h)) or plain(h, level, size))
    found = lm.Filter(None, None, None, 1, 1, 1).holding([(0, b"\xff" * 8)], 0, 1)
    assert found.levels(np.repeat(np.arange(3, dtype=np.uint64), 1000)).tolist() == [63] * 3000
    assert max(asked) == 3
    assert found.levels(np.zeros(0, np.uint64)).tolist() == []
