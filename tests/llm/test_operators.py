"""The text-corpus operators against brute force, exact round trips, held-out accuracy and hard cases."""

import collections
import hashlib
import html
import itertools
import json
import random
import re
import time
import zlib
from functools import cache

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import SF
from pyspark.sql import functions as F

from spanguard.llm import catalog, chat, decontaminate, language, mainhtml, neardup, pieces, quality, sharding, substrings, vectors
from spanguard.llm.common import Scratch, shared_dir
from spanguard.llm.components import components

WORDS = [a + b + c for a in ("ba", "ko", "ti", "mu", "re", "sa") for b in ("l", "n", "r", "st") for c in ("a", "en", "o", "ix")]
HARD = [None, "", " ", "\n", "a", "two words", "Ünïcödé ẞß 日本語 😀", "x" * 5000, "same text here " * 40, "same text here " * 40, "no space" * 300]


def prose(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


# ---- SQL


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_its_sql(name, same):
    same(catalog.QUERIES[name], catalog.ORACLE_SQL[name])


# ---- sharding


@pytest.fixture(scope="module")
def uneven(docs_of):
    r = random.Random(1)
    texts = [prose(r, r.randint(1, 60)) for _ in range(1500)] + ["copied text of a hot group"] * 900 + HARD + [None] * 50
    return texts, docs_of(texts)


def test_shards(uneven):
    texts, docs = uneven
    rows = sharding.shard(docs, 16).collect()
    size = {i: len((t or "").encode()) + 1 for i, t in enumerate(texts)}
    assert {r.doc_id: r.size for r in rows} == size
    assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in rows)
    loads, slots, homes = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for r in rows:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
        homes[texts[r.doc_id]].add(r.shard)
    assert set(loads) == set(range(16)) and max(loads.values()) <= 1.1 * sum(loads.values()) / 16 + max(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    hot = "copied text of a hot group"
    assert all(len(h) == 1 for t, h in homes.items() if t != hot)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def test_shards_of_few_rows(docs_of):
    assert sharding.shard(docs_of([]), 16).count() == 0
    rows = sharding.shard(docs_of(["a", "a", None], ids=[5, 5, None]), 4).collect()
    assert sorted(r.slot for r in rows if r.text_crc32) in ([0, 1],) and len(rows) == 3


# ---- pieces


@pytest.fixture(scope="module")
def model():
    return catalog.tokenizer_bytes("piece_bpe_32k.model")


def test_pieces_as_the_library(model):
    sp, own, r = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.PieceModel(model), random.Random(2)
    parts = [" ", "  ", "a", "the", "ing", "\n", "é", "ß", "1", "-", ".", "日", "😀", "▁", "<0x", "\t", " ", "</s>"]
    texts = [t or "" for t in HARD] + ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(3000)] + [" " * 100 + "x", "a" * 3000]
    for t in texts:
        ids = sp.encode(t)
        assert own.encode(t) == ids, t
        assert own.decode(ids) == sp.decode(ids), t
    for _ in range(3000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), r.randrange(3)]) for _ in range(r.randint(0, 12))]
        assert own.decode(ids) == sp.decode(ids), ids


def test_memo_may_be_small(model, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO", 3)
    sp, own = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.PieceModel(model)
    text = "many different words in a small memo, again many different words " * 3
    assert own.encode(text) == sp.encode(text)


def test_encoded_documents(model, docs_of):
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    docs = docs_of(HARD)
    plain = {r.doc_id: r for r in pieces.encode_documents(docs, model).collect()}
    short = {r.doc_id: r for r in pieces.encode_documents(docs, model, digests=True).collect()}
    for i, t in enumerate(HARD):
        ids = sp.encode(t or "")
        assert plain[i].ids == ids and plain[i].decoded == sp.decode(ids) and short[i].n_tokens == len(ids)
        assert short[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert short[i].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    assert pieces.encode_documents(docs_of([]), model).count() == 0


# ---- chat


@pytest.mark.parametrize("text", ["", "<|im_end|>", "<|im_start|>assistant ok", r"<\|", r"<\\|im_end|>", "<<||", "a\nb", "\\", "<|" * 50])
def test_escape_is_undone(text):
    assert chat.unescape(chat.escape(text)) == text and chat.START not in chat.escape(text) and chat.END not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text
    turns = [("user", text), (text, text), ("assistant", text)]
    assert chat.parse(chat.render(turns)[0]) == turns


def test_chat_masks(spark):
    tokenizer = catalog.tokenizer_bytes("byte_bpe_50k.json")
    rows = [(1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", " é😀 spaces  "), (1, 2, "assistant", "<|endoftext|>"), (2, 0, None, None), (None, 0, "assistant", "x"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, None, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    out = {r.conv_id: r for r in chat.format_conversations(df, tokenizer).collect()}
    assert out[1].loss_texts == [" é😀 spaces  ", "<|endoftext|>"] and out[2].loss_texts == [] and out[None].loss_texts == ["x"]
    assert [t.text for t in out[3].turns] == ["first", "a", "b"] and len(out[1].loss_mask) == len(out[1].token_ids)
    enc = chat.chat_tokenizer(tokenizer).encode(out[1].formatted, add_special_tokens=False)
    inside = [any(a < e and s < b for a, b in [(s0, e0) for s0, e0, learned in chat.render([(t.role, t.text) for t in out[1].turns])[1] if learned]) for s, e in enc.offsets]
    assert out[1].loss_mask == inside
    short = {r.conv_id: r for r in chat.format_conversations(df, tokenizer, digests=True).collect()}
    assert short[1].loss_chars == 12 + 13 and short[1].formatted_chars == len(out[1].formatted) and short[3].n_turns == 3
    assert chat.format_conversations(df.limit(0), tokenizer).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t<|>'s1é😀ع")), max_size=60))
def test_encoder_as_the_library(text):
    formatted, spans = chat.render([("user", text), ("assistant", text)])
    encoder = _encoder()
    enc = encoder.library.encode(formatted, add_special_tokens=False)
    ids, offsets = encoder.encode(formatted)
    assert encoder.fast and ids == enc.ids and offsets.tolist() == [list(x) for x in enc.offsets]
    assert chat.masked_text(formatted, offsets, chat.token_mask(offsets, spans), spans) == [chat.escape(text)]


@cache
def _encoder():
    return chat.Encoder(catalog.tokenizer_bytes("byte_bpe_50k.json"))


def test_encoder_of_long_runs_and_other_definitions():
    encoder = _encoder()
    for text in (" " * 300_000 + "x", "x" * 300_000, "\n" * 300_000):
        formatted, spans = chat.render([("assistant", text)])
        ids, offsets = encoder.encode(formatted)
        assert ids == encoder.library.encode(formatted, add_special_tokens=False).ids
        assert chat.masked_text(formatted, offsets, chat.token_mask(offsets, spans), spans) == [text]
    other = json.loads(catalog.tokenizer_bytes("byte_bpe_50k.json"))
    other["normalizer"] = {"type": "Lowercase"}
    assert chat.Encoder(json.dumps(other).encode()).fast is None


# ---- quality


def test_quality(spark):
    rows, r = [], random.Random(4)
    for i in range(900):
        text = prose(r, 40)
        kind = i % 5
        if kind == 1:
            text = " ".join(f"{w}$$$" for w in text.split()).upper()
        if kind == 2:
            words = text.split()
            for k in range(0, 40, 8):
                words[k] = r.choice(["vile", "nasty", "awful"])
            text = " ".join(words)
        rows.append((i, text, f"s{i % 4}", "en", kind))
    docs = spark.createDataFrame(rows + [(900, None, None, None, 0), (901, " ", "s", "en", 0)], "doc_id long, text string, source string, lang string, kind int")
    labels = docs.where("doc_id < 600").select("doc_id", F.when(F.col("kind") == 1, 0).otherwise(1).alias("quality"), (F.col("kind") == 2).cast("int").alias("toxic")).unionByName(spark.createDataFrame([(5, None, 1), (99999, 1, 0)], "doc_id long, quality int, toxic int"))
    out = {x.doc_id: x for x in quality.quality(docs, labels).collect()}
    held = [(i, k) for i, _, _, _, k in rows if i >= 600]
    assert np.mean([out[i].kept for i, k in held if k not in (1, 2)]) > 0.97
    assert np.mean([out[i].kept for i, k in held if k == 1]) < 0.03 and np.mean([out[i].kept for i, k in held if k == 2]) < 0.1
    assert not out[900].kept and out[900].score == 0 and not out[901].kept
    # one kind of label, or none
    assert {x.score for x in quality.quality(docs.limit(5), labels.where("toxic = 0 and quality = 1")).collect()} <= {0.0, 1.0}
    assert quality.quality(docs.limit(5), labels.limit(0)).count() == 5
    assert quality.quality(docs.limit(0), labels).count() == 0


# ---- html


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="with-sidebar"><header><a href=/>Home</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div class="cookie-notice">We use cookies, please accept them all.</div><form>Search here <input name=q></form><div class="ad">Buy this wonderful thing right now, it is very cheap.</div>
<article><h1>A &amp; B</h1><p><b>First&nbsp;paragraph is   here.<br>Second line.<p>Another &eacute;&#8217;s one.</p><ul><li>item one<li>item two</ul><blockquote>Quoted.</blockquote><section class="comments"><p>Great article, thank you so much for writing it.</p></section></article>
<aside>Related: <a href=x>more</a></aside><footer>&copy; 2024 somebody</footer><p hidden>hidden words in a paragraph</p></body></html><!-- never closed"""


def test_main_text():
    assert mainhtml.main_text(PAGE) == "A & B\nFirst paragraph is here. Second line.\nAnother é’s one.\nitem one\nitem two\nQuoted."
    assert mainhtml.main_text(None) == mainhtml.main_text("") == mainhtml.main_text("<nav>a</nav>") == ""
    assert mainhtml.main_text("<article>cut off at <b>a tag <a hre") == "cut off at a tag"
    assert mainhtml.main_text("<article>" + "<p>A long paragraph of words.</p>" * 3000) == "\n".join(["A long paragraph of words."] * 3000)


def test_hostile_pages_take_linear_time():
    n = 60_000
    pages = ["<a " * n, '<a ">' * n, "<a '\"" * n, "<div>" * n + "</x>" * n, "<b>" * n + "t<hr>" * n, "<p><table>" + "<b>" * n + "t<hr>" * n, "<!--" * n, "</" * n, "<li>x" * n, "<script>" * n, "<" * n, "&" * n, "<p>a b c</p><p>Two words, and more.</p>" * (n // 10)]
    began = time.process_time()
    for page in pages:
        mainhtml.main_text(page)
    assert time.process_time() - began < 60
    assert mainhtml.main_text('<article><p title="never closed>One sentence here.</p><p>Another one here.</p></article>') == "One sentence here.\nAnother one here."


def test_pages_without_an_article_element(spark):
    """The text's own features and what other pages repeat, where no word of the markup helps."""
    r = random.Random(29)
    pages, want = [], []
    for i in range(60):
        body = [prose(r, r.randint(20, 60)).capitalize() + "." for _ in range(3)]
        if r.random() < 0.5:
            body[1] = " ".join(prose(r, 8).capitalize() + ("," if k % 2 else ".") for k in range(4)) + "."
        menu = "".join(f"<li><a href=/{k}>{prose(r, 1)}</a></li>" for k in range(6))
        pages.append(f"<div><ul>{menu}</ul></div><div>{''.join(f'<p>{b}</p>' for b in body)}</div><div><p>This site uses small files to remember you, as most others do.</p><p>Some rights reserved 2024 | Imprint</p></div>")
        want.append("\n".join(body))
    telling = [f"<body><nav><a href=/>{prose(r, 2)}</a></nav><article><p>{prose(r, r.randint(8, 60)).capitalize()}.</p><p>{prose(r, r.randint(8, 60)).capitalize()}.</p></article></body>" for _ in range(20)]
    weights = mainhtml.fit(mainhtml.counted(pages + telling))
    got = [mainhtml.chosen(blocks, weights) for blocks in mainhtml.counted(pages)]
    assert sum(g == w for g, w in zip(got, want)) >= 57


KEPT = ["<p class=\"comment-on-the-law\">{}</p>", "<div class=\"share-prices\"><p>{}</p></div>", "<p class=\"ad-hoc\">{}</p>", "<noscript><p>{}</p></noscript>", "<div id=\"search-for-meaning\">{}</div>", "<p class=\"no-ads lead\">{}</p>"]
GONE = ["<div class=\"comment-list\">{}</div>", "<div class=\"article-footer\">{}</div>", "<p class=\"ad\">{}</p>", "<div class=\"shareButtons\">{}</div>", "<div id=\"cookie_banner\">{}</div>"]


def test_words_within_class_names(spark):
    """A name that only holds a word of boilerplate doesn't cost an article its paragraphs."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    fitted = mainhtml.fit(mainhtml.counted([r.html for r in pages.collect()]))
    for weights in (mainhtml.PLAIN, fitted):
        for shape in KEPT + GONE:
            page = f"<article><p>One sentence of the text.</p>{shape.format('Another sentence that says more, and more.')}<p>A last sentence of it.</p></article>"
            kept = ["Another sentence that says more, and more."] * (shape in KEPT)
            assert mainhtml.main_text(page, weights) == "\n".join(["One sentence of the text.", *kept, "A last sentence of it."]), shape


def test_articles_keep_what_they_share():
    """Paragraphs of articles that many pages of a host have stay; the same words outside go."""
    r = random.Random(33)
    shared = [prose(r, 20).capitalize() + "." for _ in range(2)]
    pages = [f"<div><p>{shared[0]}</p></div><article><h1>{prose(r, 4)}</h1><p>{prose(r, 30)}.</p><p>{shared[1]}</p></article>" for _ in range(40)]
    blocks = mainhtml.counted(pages)
    for weights in (mainhtml.PLAIN, mainhtml.fit(blocks)):
        texts = [mainhtml.chosen(b, weights).split("\n") for b in blocks]
        assert all(len(t) == 3 and t[2] == shared[1] and shared[0] not in t for t in texts)


@pytest.mark.parametrize("repeats", [1_000_000, 0])
def test_many_hosts_of_two_pages(spark, repeats, monkeypatch):
    """What a host repeats goes, though no sample sees two of its pages and no markup tells; copies of a page repeat nothing."""
    monkeypatch.setattr(mainhtml, "REPEATS", repeats)
    r, rows, want = random.Random(31), [], {}
    for host in range(1000):
        line = prose(r, 14).capitalize() + "."
        for k in range(2):
            body = [prose(r, r.randint(15, 40)).capitalize() + "." for _ in range(2)]
            html_ = f"<div><p>{line}</p></div><div><p>{body[0]}</p><p>{body[1]}</p></div>"
            want[len(rows)] = "\n".join(body)
            rows.append((len(rows), f"https://Host{host}.example/{k}", html_))
    for k in range(5):  # copies under other names
        want[len(rows)] = want[0]
        rows.append((len(rows), f"https://host0.example/copy{k}", rows[0][2]))
    out = {x.page_id: x.text for x in mainhtml.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)).collect()}
    assert len(out) == len(rows) and sum(out[i] == want[i] for i in want) >= 0.98 * len(rows)


def test_attributes_by_their_whole_names():
    shown = ['href="/hidden-gems"', "href=/hidden", 'title="A hidden lake"', "title='style = \"display:none\"'", 'data-hidden="false"', "data-hidden", 'x-class="sidebar"', 'data-id=footer title=" id=nav "', 'hidden-x', 'alt = "role=navigation"', 'a="b"title="hidden"']
    for attrs in shown:
        for tag in ("p", "div"):
            page = f"<article><p>One sentence of text.</p><{tag} {attrs}>Another sentence of text.</{tag}></article>"
            assert mainhtml.main_text(page) == "One sentence of text.\nAnother sentence of text.", attrs
        assert mainhtml.main_text(f"<article><p>A <a {attrs}>link</a> in a sentence.</p></article>") == "A link in a sentence.", attrs
    for attrs in ("hidden", "HIDDEN", 'hidden=""', "hidden = hidden", 'title="a"hidden', 'href=/x hidden', "hidden/", 'aria-hidden="true"', "STYLE='display: none'"):
        assert mainhtml.main_text(f"<article><p>One sentence of text.</p><div><p {attrs} >Another sentence.</p></div></article>") == "One sentence of text.", attrs


def test_classifier_is_fitted(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    weights = mainhtml.fit(mainhtml.counted([*pages, None, "", "<p>says nothing</p>"]))
    assert mainhtml.main_text(PAGE, weights) == mainhtml.main_text(PAGE)
    plain = "<div><a href=1>Home</a></div><p>A plain page with a single sentence of text that is quite long. And another one here.</p>"
    assert mainhtml.main_text(plain, weights) == "A plain page with a single sentence of text that is quite long. And another one here."
    assert mainhtml.fit([]) == mainhtml.fit(mainhtml.counted(["<p>says nothing</p>"])) == mainhtml.PLAIN


def test_cut_is_minimal():
    r = random.Random(7)
    for _ in range(200):
        n = r.randint(1, 8)
        odds = [r.uniform(-3, 3) for _ in range(n)]
        edges = [(i, j, r.uniform(0, 2)) for i in range(n) for j in range(i) if r.random() < 0.5]

        def cost(side):
            return sum(-o if s and o < 0 else o if not s and o > 0 else 0 for s, o in zip(side, odds)) + sum(w for a, b, w in edges if side[a] != side[b])

        assert cost(mainhtml.minimum_cut(odds, edges)) == pytest.approx(min(map(cost, itertools.product([False, True], repeat=n))))


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (1, "u", PAGE)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    out = mainhtml.extract_pages(pages).collect()
    assert len(out) == 3 and all(r.n_chars == len(r.text) for r in out)
    assert mainhtml.extract_pages(pages.limit(0)).count() == 0
    real = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    for p in real.collect():
        inner = re.search("<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        want[p.page_id] = "\n".join(b for b in blocks if b)
    assert {r.page_id: r.text for r in mainhtml.extract_pages(real).collect()} == want


# ---- decontamination


def test_masks_miss_no_two_differences():
    for missing in itertools.combinations(range(decontaminate.WINDOW), decontaminate.MISSES):
        assert any(all(o + p not in missing for p in m) for m in decontaminate.MASKS for o in range(decontaminate.WINDOW - max(m)))


def overlap_by_force(doc, item):
    apart = lambda t: re.sub(r"([\u4e00-\u9fff\u3040-\u30ff\u0e00-\u0e2e])", r" \1 ", t.lower())
    w = re.split(r"[^\w]+", apart(doc or ""))
    m = [x for x in re.split(r"[^\w]+", apart(item)) if x]
    width, need = min(13, len(m)), 11 if len(m) >= 13 else len(m)
    w = [None] * 13 + w + [None] * 13
    return bool(m) and any(sum(w[i + k] == m[j + k] for k in range(width)) >= need for i in range(len(w) - width + 1) for j in range(len(m) - width + 1))


@pytest.mark.parametrize("bits, hits", [(1 << 20, 64), (64, 2)])
def test_overlaps(spark, docs_of, bits, hits, monkeypatch):
    """Items of 1 to 50 words, some in scripts without spaces; a full bitmap and documents of many hits give the same."""
    monkeypatch.setattr(decontaminate, "BITS", bits)
    monkeypatch.setattr(decontaminate, "HITS", hits)
    r = random.Random(8)
    items = [prose(r, n) for n in (2, 3, 4, 5, 6, 7, 10, 13, 14, 30, 50)] + [None, "", " .. ", "zebra", "日本語", "これはとてもながいながいぶんしょうですね", "日", "x 本 y"]
    items.append(items[7])
    texts = list(HARD) + ["a zebra here", "zebras", "今日は日本語だ", "一日本語", "これはとてもながいながいぶんしょうですね。", "前これはとてもなかいながいぶんしょうてすね後", "x本y", "日 本 語", (" ".join(items[7].split()[:12]) + " ") * 300]
    for _ in range(80):
        words = prose(r, r.randint(0, 20)).split() + (m := r.choice([i for i in items if i]).split()) + prose(r, r.randint(0, 10)).split()
        for _ in range(r.randint(0, 5)):
            if words:
                words[r.randrange(len(words))] = r.choice(WORDS)
        cut = r.randint(0, len(m) // 2)
        texts.append(" ".join(words[cut:]).capitalize() + ".")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    found = decontaminate.decontaminate(docs_of(texts), bench).collect()
    got = {x.doc_id: set(x["items"]) for x in found}
    assert got == {i: {k for k, m in enumerate(items) if m and overlap_by_force(t, m)} for i, t in enumerate(texts)}
    assert 20 < sum(map(bool, got.values())) < len(texts) - 5
    at = decontaminate.overlaps(docs_of(texts), bench).collect()
    covered = collections.Counter({i: len({p for x in at if x.doc_id == i for s in x.spans for p in range(s.start, s.stop)}) for i in got})
    assert all(x.n_words == covered[x.doc_id] and x.n_items == len(got[x.doc_id]) for x in found)
    kept = decontaminate.drop_contaminated(docs_of(texts), bench)
    assert {x.doc_id for x in kept.collect()} == {i for i, s in got.items() if not s} and kept.columns == docs_of([]).columns
    assert decontaminate.decontaminate(docs_of(texts), bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.decontaminate(docs_of([]), bench).count() == 0


def test_short_items_by_sql(spark, docs_of, tmp_path):
    """The query's SQL, on benchmark items of 1 to 6 words."""
    import duckdb

    r = random.Random(12)
    items = [prose(r, n) for n in (1, 2, 3, 4, 5, 6, 9, 13, 20)] + ["日本"]
    texts = [prose(r, 12) + " " + r.choice(items) + " " + prose(r, 12) for _ in range(60)] + ["東日本の", "", None]
    docs_of(texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {tuple(x) for x in catalog.op6_decontaminate(spark, str(tmp_path)).collect()}
    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert got == set(duck.execute(catalog.ORACLE_SQL["op6_decontaminate"]).fetchall()) and sum(x[4] for x in got) >= 61


# ---- near duplicates


def components_by_force(n, linked):
    root = list(range(n))
    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    return root


def near_by_force(texts, k, percent):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()

    s = [shingles(t) for t in texts]
    link = lambda i, j: bool(s[i]) and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j])
    return [len(x) for x in s], components_by_force(len(texts), link)


def copies(r, n, size, edits):
    base = prose(r, size).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(size)] = r.choice(WORDS)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("k,percent,leaf", [(3, 85, 2048), (5, 80, 2048), (3, 85, 8)])
def test_near_duplicates(docs_of, monkeypatch, k, percent, leaf):
    monkeypatch.setattr(neardup, "LEAF", leaf)
    r = random.Random(9)
    texts = list(HARD) + ["Two Words", "TWO  words"] + [prose(r, 60) for _ in range(60)]
    for n, size, edits in ((60, 120, 3), (25, 200, 12), (10, 50, 1), (4, 300, 40)):
        texts += copies(r, n, size, edits)
    sizes, want = near_by_force(texts, k, percent)
    got = {x.doc_id: x for x in neardup.near_duplicates(docs_of(texts), k, percent).collect()}
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert [got[i].component_id for i in range(len(texts))] == want
    assert all(x.kept == (x.doc_id == x.component_id) for x in got.values())


def test_near_duplicates_hard_cases(docs_of):
    docs = docs_of(["a b c d e f g", "a b c d e f g", "x y z u v w", None, "a b c d e f g"], ids=[3, 3, None, 7, 9])
    out = neardup.near_duplicates(docs, 3, 85).collect()
    assert sorted((x.doc_id or -1, x.component_id or -1) for x in out) == [(-1, -1), (3, 3), (3, 3), (7, 7), (9, 3)]
    kept = neardup.drop_near_duplicates(docs, 3, 85)
    assert sorted(x.doc_id or -1 for x in kept.collect()) == [-1, 3, 7] and kept.columns == docs.columns
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("percent,trees,levels", [(80, 5, 1), (85, 3, 2)])
def test_missed_pairs_as_simulated(percent, trees, levels):
    """The closed form against draws of coordinates that agree, first ones and bands among them."""
    r, n = np.random.default_rng(5), 40_000
    agree = r.random((n, neardup.COORDS)) < percent / 100
    met = np.zeros(n, bool)
    for t in range(trees):
        own = agree[:, t].copy()
        for _ in range(levels):
            at = r.integers(0, neardup.COORDS, (n, neardup.BRANCHES, neardup.BAND))
            own &= np.take_along_axis(agree[:, None, :], at, 2).all(2).any(1)
        met |= own
    expected = neardup.missed(percent, trees, levels)
    assert abs((~met).mean() - expected) < 5 * (expected / n) ** 0.5
    assert neardup.missed(85, neardup.trees_for(85)) <= neardup.MISS and neardup.trees_for(100) == 1


def test_measured_recall(spark, docs_of):
    """Links of sampled documents, counted by pairs; a result that connects nothing has none of them."""
    r = random.Random(8)
    texts = []
    for i in range(12):
        words = [f"w{r.randrange(10**6)}" for _ in range(60)]
        texts += [" ".join(words), " ".join([*words[:-1], f"x{i}"]), " ".join(words)][: 1 + i % 3]
    texts += [None, "", "one", "one"]
    docs = docs_of(texts)
    found = neardup.near_duplicates(docs, 3, 85)
    sets = [set(neardup.shingle_set(t, 3, neardup._Words())) for t in texts]
    distinct = {t for t, s in zip(texts, sets) if s}
    own = {t: texts.index(t) for t in distinct}
    pairs = sum(100 * len(sets[i] & s) >= 85 * len(sets[i] | s) for t, i in own.items() for j, s in enumerate(sets) if j != i and s)
    assert tuple(neardup.measured_recall(docs, found, 3, 85).first()) == (len(distinct), pairs, pairs) and pairs > 10
    apart = found.withColumn("component_id", F.col("doc_id"))
    assert tuple(neardup.measured_recall(docs, apart, 3, 85).first()) == (len(distinct), pairs, 0)
    assert tuple(neardup.measured_recall(docs.limit(0), found.limit(0), 3, 85).first()) == (0, 0, 0)



def test_components(spark):
    r = random.Random(10)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)] + [(7, 7)]
    pairs = {frozenset(e) for e in edges}
    want = components_by_force(560, lambda i, j: frozenset((i, j)) in pairs)
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t")).collect()}
    assert got == {i: want[i] for a, b in edges if a != b for i in (a, b)}


# ---- repeated strings


def repeats_by_force(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[p : p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("group", [256, 1])
def test_repeats(docs_of, group):
    r = random.Random(11)
    base = ["".join(r.choice("abcé\n ") for _ in range(300)) for _ in range(6)]
    texts = HARD + ["ab" * 300, "é" * 200] + ["".join(r.choice(base)[r.randrange(50) : r.randrange(100, 300)] for _ in range(r.randint(1, 8))) for _ in range(150)]
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in substrings.remove_repeats(docs_of(texts), 40, group=group).collect()}
    want = repeats_by_force(texts, 40)
    assert [got[i] for i in range(len(texts))] == want


def passages_by_force(texts, length):
    """The texts without the words of any ``length`` in a row that also stand in a row elsewhere, and the white space behind them."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = collections.Counter(tuple(w[p : p + length]) for w in words for p in range(len(w) - length + 1))
    out = []
    for t, w in zip(texts, words):
        gone = {q for p in range(len(w) - length + 1) if seen[tuple(w[p : p + length])] > 1 for q in range(p, p + length)}
        parts = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", t or "")
        ahead = (t or "")[: len(t or "") - sum(map(len, parts))]
        out.append(t and ahead + "".join(x for k, x in enumerate(parts) if k not in gone))
    return out


@pytest.mark.parametrize("text, letter", [("½", False), ("²", False), ("Ⅷ", False), ("①", False), ("٣", False), ("5 %", False), ("_", False), ("", False), ("日", True), ("½ x", True), ("ª", True), ("ж", True)])
def test_letters(text, letter):
    assert language.has_letter(text) == letter


@pytest.mark.parametrize("group", [0, 256])
def test_passages(docs_of, group):
    r = random.Random(23)
    shared = [prose(r, 12), "  \n".join("a bc d é 日 f g".split()), prose(r, 40), "x y " * 12]
    gap = lambda: r.choice(["", " ", "\n ", "\t"])
    texts = HARD + [gap() + prose(r, 20) + gap() + r.choice(shared) + gap() + prose(r, 20) + gap() for _ in range(40)] + [prose(r, 5) for _ in range(5)]
    texts += [" ".join("abcdefghij"[k % 10] for k in range(a, a + 30)) for a in range(3)] + ["w" * 3_000_000 + " " + shared[2], "w" * 3_000_000 + " " + shared[2] + " end"]
    for length in (7, 11):
        got = {x.doc_id: x.text for x in substrings.strip_repeats(docs_of(texts), length, unit="words", group=group).collect()}
        assert [got[i] for i in range(len(texts))] == passages_by_force(texts, length)


def test_false_matches_are_found_out(monkeypatch):
    """Windows whose rolling hashes agree are told apart by their bytes."""
    held = [(1, 0, 0, 3, 5, 9, 1, b"abcdefghijkl"), (2, 0, 0, 3, 5, 9, 1, b"abcdefghijkX")]
    owner, begin = np.repeat([0, 1], 4), np.array([0, 4, 8])
    like = np.array([0, 1, 2, 3, 0, 1, 2, 3])
    assert substrings._same_bytes(held, begin, owner, like, np.array([True] * 3 + [False] + [True] * 3 + [False]), 9, 1)
    assert not substrings._same_bytes(held, begin, owner, like, np.ones(8, bool), 9, 1)


def test_repeats_hard_cases(docs_of):
    once, twice = "".join(map(chr, range(300, 500))), "".join(map(chr, range(600, 900)))
    docs = docs_of([once, twice, twice, None, "", "short"], ids=[1, 2, 2, 3, None, 5])
    out = substrings.remove_repeats(docs, 100, digests=True).collect()
    assert sorted((x.n_bytes, x.n_removed) for x in out) == sorted([(len(once.encode()), 0), *[(len(twice.encode()),) * 2] * 2, (0, 0), (0, 0), (5, 0)])
    assert substrings.remove_repeats(docs.limit(0)).count() == 0
    cut = {(x.doc_id, x.text, x.n_chars) for x in substrings.strip_repeats(docs, 100).collect()}
    assert cut == {(1, once, 200), (2, "", 0), (3, None, 0), (None, "", 0), (5, "short", 5)}


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(substrings, "PIECE", 64)
    monkeypatch.setattr(substrings, "BUFFER", 256)
    r = random.Random(12)
    texts = ["".join(r.choice("ab") for _ in range(r.randint(0, 700))).encode() for _ in range(20)]
    seen = [set() for _ in texts]
    for who, lo, hi, off, kh, ph in substrings.phrases(texts, substrings.Roller(40), 40, 10):
        for w, a, b in zip(who, lo, hi):
            assert not seen[w] & set(range(a, b + 1))
            seen[w] |= set(range(a, b + 1))
    assert [len(s) for s in seen] == [max(0, len(t) - 39) for t in texts]


# ---- vectors


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(vectors, "LEAF", 8)
    r = np.random.default_rng(13)
    base = r.normal(size=(120, 16))
    rows = [(base[i], i % 3) for i in range(120)]
    for n, spread, label in ((50, 0.03, 0), (20, 0.05, 1), (5, 0.02, 2), (30, 0.06, 1)):
        v = r.normal(size=16)
        rows += [(v + r.normal(size=16) * spread, label) for _ in range(n)]
    rows += [(rows[0][0], 0)] * 6 + [(rows[0][0] * 2, 0), (rows[0][0], 1), (rows[0][0], None), (None, 0), (np.zeros(16), 0), (np.array([np.nan] * 16), 0), (np.array([np.inf] * 16), 1), (np.ones(3), 0)]
    table = [(i, None if v is None else [float(x) for x in v], g) for i, (v, g) in enumerate(rows)] + [(len(rows), [None, 1.0], 1), (None, [1.0] * 16, 1)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int").withColumn("x", F.lit("clash"))
    unit = []
    for i, v, g in table[:-1]:
        a = np.array([np.float32(np.nan if x is None else x) for x in v or []], float)
        n = np.sqrt((a * a).sum())
        unit.append((a / n, g) if len(a) and np.isfinite(a).all() and n > 0 and g is not None else None)
    near = lambda i, j: bool(unit[i] and unit[j] and unit[i][1] == unit[j][1] and len(unit[i][0]) == len(unit[j][0]) and unit[i][0] @ unit[j][0] >= 0.98)
    want = components_by_force(len(unit), near)
    got = {x.vec_id: x for x in vectors.near_vectors(df).collect()}
    assert [got[i].component_id for i in range(len(unit))] == want
    assert [got[i].n_links for i in range(len(unit))] == [sum(near(i, j) for j in range(len(unit)) if j != i) for i in range(len(unit))]
    assert got[None].kept and got[None].component_id is None
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_bridged_groups(spark):
    """Two dense groups whose links with each other are in no list."""
    r = np.random.default_rng(17)
    a, b = np.linalg.qr(r.normal(size=(64, 2)))[0].T
    v = np.concatenate([c + r.normal(size=(200, 64)) * 0.003 for c in (a, 0.982 * a + np.sqrt(1 - 0.982**2) * b)])
    v = v.astype(np.float32).astype(float)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.98
    assert near[:200, :200].all() and near[200:, 200:].all() and 20000 < near[:200, 200:].sum() < 40000
    df = spark.createDataFrame([(i, [float(e) for e in x], 1) for i, x in enumerate(v)], "vec_id long, embedding array<float>, label int")
    got = {x.vec_id: x for x in vectors.near_vectors(df).collect()}
    assert {x.component_id for x in got.values()} == {0} and [i for i in got if got[i].kept] == [0]
    assert [got[i].n_links for i in range(400)] == (near.sum(1) - 1).tolist()


def test_bridge_of_all_vectors(spark, monkeypatch):
    """What is left if the audit stays low: no link is missed even without lists, and cells are split."""
    monkeypatch.setattr(vectors, "BLOCK", 16)
    r = np.random.default_rng(19)
    v = np.concatenate([c + r.normal(size=(30, 8)) * 0.25 for c in r.normal(size=(4, 8))])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = lambda i, j: v[i] @ v[j] >= 0.98
    rows = spark.createDataFrame([(i, 1, [float(e) for e in x]) for i, x in enumerate(v)], "x long, part long, v array<double>")
    scratch = vectors.Scratch(spark, "bridge")
    none, roots = spark.createDataFrame([], "x long, k int, l array<struct<s: double, y: bigint>>"), spark.createDataFrame([], "node long, root long")
    want = components_by_force(len(v), near)
    assert 4 < len(set(want)) < 120
    got = {x.node: x.root for x in vectors.bridge(none, rows, roots, scratch, 0.98, whole=True).collect()}
    assert [got[i] for i in range(len(v))] == want


# ---- language


def test_gradients():
    net = language.ByteNet(["a", "b", "c"])
    r = np.random.default_rng(14)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, y = r.integers(0, 256, (4, 12)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, g = net.step(x, y)
    for name in net.w:
        for _ in range(6):
            at = tuple(r.integers(0, s) for s in net.w[name].shape) if name != "emb" else (int(x[0, r.integers(12)]), int(r.integers(language.EMBED)))
            keep, e = net.w[name][at], 1e-5
            net.w[name][at] = keep + e
            up = net.step(x, y)[0]
            net.w[name][at] = keep - e
            down = net.step(x, y)[0]
            net.w[name][at] = keep
            assert (up - down) / (2 * e) == pytest.approx(g[name][at], abs=1e-6)


def test_tables_are_the_network():
    net = language.ByteNet(["a", "b"])
    x = np.random.default_rng(15).integers(0, 256, (3, language.WINDOW)).astype(np.uint8)
    e = net.w["emb"][x]
    h = [np.maximum((np.concatenate([e[:, j : j + x.shape[1] - k + 1] for j in range(k)], 2) @ net.w[f"c{k}"] + net.w[f"b{k}"]).max(1), 0) for k in language.WIDTHS]
    assert language.window_logits(net.tables(), x) == pytest.approx(np.concatenate(h, 1) @ net.w["out"] + net.w["out_b"], abs=1e-4)


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows) and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.9


def test_language_hard_cases(spark, docs_of):
    docs = docs_of(["the cat and the dog"] * 8 + HARD + ["123 $$"])
    out = {r.doc_id: r for r in language.language_id(docs).collect()}
    assert all(out[8 + i].lang_pred == "und" and out[8 + i].score == 0 for i in range(4)) and out[8 + len(HARD)].lang_pred == "und"
    assert out[0].lang_pred == "en"
    assert {r.lang_pred for r in language.language_id(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.language_id(docs.limit(0)).count() == 0


# ---- common


def test_shared_dir_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
