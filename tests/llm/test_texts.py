"""Quality rules, language identification and main text of pages."""

import random
import zlib

import plain
import pytest
from pyspark.sql import functions as F
from test_dedup import SCHEMA, collected, corpus, frame

from tidewatch.llm import html, language, quality

SMALL = "/root/testdata/sf0.01"


def test_base_rules(spark):
    rows = corpus(4)
    got = quality.judge(frame(spark, rows))
    want = []
    for i, t in rows:
        n, chars, symbols, lines, repeats = plain.base_rules(t)
        want.append((i, n, chars, symbols, lines, repeats, n < 20 or 100 * repeats > 30 * n))
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert collected(got, *columns) == sorted(want, key=repr)
    assert got.where("base_failed AND kept").count() == 0
    assert quality.judge(frame(spark, [])).collect() == []


def test_repeats_whose_hashes_meet(monkeypatch):
    """Windows are compared word by word after their hashes."""
    words = [f"w{k % 11}" for k in range(40)] + [f"v{k}" for k in range(30)]
    text = " ".join(words)
    assert quality.measure(text)[4] == plain.base_rules(text)[4]


def test_thresholds_follow_language_and_source(spark):
    """A source whose texts all have many symbols keeps them; one odd text in a plain source goes."""
    rnd = random.Random(1)
    prose = lambda n, mark: " ".join(f"{'word'[:rnd.randrange(2, 5)]}{k}{mark if rnd.random() < 0.5 else ''}" for k in range(n))
    rows = [(i, prose(60, "#"), "en", "code", 0) for i in range(80)] + [(100 + i, prose(60, ""), "en", "books", 0) for i in range(80)]
    rows += [(500, prose(60, "#"), "en", "books", 0), (501, prose(60, ""), None, None, 0), (502, prose(60, "##"), None, None, 0)]
    got = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i]["kept"] for i in [*range(80), *range(100, 180), 501])
    assert not got[500]["kept"] and got[500]["odd"] == ["symbols"]


def test_every_rule_can_be_broken(spark):
    """One planted text for each rule, all of them past the base rules, beside clean ones."""
    plain_ = lambda i, n=60: [f"w{i}x{k}" for k in range(n)]
    rows = [(i, " ".join(plain_(i)), "en", "s", 0) for i in range(200)]
    again = plain_(300, 14) + plain_(301, 72)
    odd = {"word_length": " ".join(w * 4 for w in plain_(400)), "symbols": " ".join(w + "#" for w in plain_(401)),
           "dup_lines": "\n".join(f"a{k} b{k} c{k}\nyes" for k in range(12)), "repeats": " ".join(again + again[:14]),
           "again": " ".join(f"{w} {w}" for w in plain_(402, 30))}
    rows += [(rule, t, "en", "s", 0) for rule, t in odd.items()]
    docs = spark.createDataFrame([(str(i), *r) for i, *r in rows], SCHEMA.replace("doc_id long", "doc_id string"))
    got = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert {i for i, r in got.items() if not r["kept"]} == set(odd)
    assert all(rule in got[rule]["odd"] for rule in odd)


def test_sketches_merge_and_hold_their_error(spark):
    rows = frame(spark, [(i, " ".join("x" * (1 + (i * k) % 9) for k in range(30))) for i in range(300)])
    measured = quality.features(rows)
    halves = [quality.sketch(measured.where(f"id % 2 = {k}")) for k in (0, 1)]
    whole = quality.sketch(measured)
    merged = halves[0].union(halves[1]).groupBy("lang", "source", "rule", "bucket").agg(F.sum("n").alias("n"))
    key = ("lang", "source", "rule", "bucket", "n")
    assert collected(merged, *key) == collected(whole, *key)
    limits = {r["rule"]: r for r in quality.fences(whole, ["lang"]).collect()}
    values = sorted(r[0] for r in measured.select(F.expr("word_chars / n_words")).collect())
    low, high = values[len(values) // 4 - 1], values[3 * len(values) // 4 - 1]
    reach = max(high - low, 0.6) * quality.REACH
    assert abs(limits["word_length"]["most"] - (high + reach)) < 0.02 * high * (1 + 2 * quality.REACH)


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got) and len(out) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_kernel_weights_are_the_kernel(spark):
    """The product with folded weights gives what the kernels with the landmarks would."""
    table = language.symbols("etaoinshrdlu")
    sets = [set(language.grams(t, table).tolist()) for t in ("the tide", "a tide of the sea", "tide")]
    assert len(sets[2] & sets[0]) == len(sets[2])
    assert language.grams("a  --  b", table).tolist() == language.grams("a b", table).tolist()
    assert language.grams("1 2", table)[0] == 0


def test_language_of_odd_rows(spark):
    rows = [(i, ("der die und das " if i % 2 else "the of and that ") * 5 + str(i), "de" if i % 2 else "en", "s", 0) for i in range(60)]
    rows += [(None, "und das", "de", None, None), (70, None, "de", "s", 0), (71, "", "xx", "s", 0), (72, "12 !?", None, "s", 0), (73, "the and", None, None, 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("lang_pred", F.lit("zz")).withColumn("doc", F.lit(1))
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert len(got) == len(rows)
    assert [(got[k]["lang_pred"], got[k]["score"]) for k in (70, 71, 72)] == [("und", 0.0)] * 3
    assert got[73]["lang_pred"] == "en" and got[None]["lang_pred"] == "de" and got[None]["held_out"] is False
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(none).collect()} == {"und"}
    assert language.identify(docs.where("false")).collect() == []


MENU = '<nav><a href="/">Home</a> <a href="/x">News</a></nav>'
FRAME = ('<!DOCTYPE html><html><head><title>T</title><script>var a="</p><article>no</article>";</script></head><body>{menu}<!-- <p>no</p> -->'
         '<div class="cookie-notice">We use cookies on every page of this site so that it works well</div>{body}<footer>&copy; all of us 2020</footer></body></html>')


def pages(spark, bodies, host="a.example"):
    rows = [(k, f"http://{host}/{k}", None if b is None else FRAME.format(menu=MENU, body=b), "x") for k, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string")


def text_of(df):
    return {r["page_id"]: r["text"] for r in html.extract(df).collect()}


def test_articles(spark):
    shared = " ".join(f"s{k}" for k in range(30))
    bodies = [f"<article><h1>Title {k}</h1><p>One <b>bo</b>ld&amp;x &eacute;\n  {shared}<br>own{k} words<p>more<div class='share'>Tweet</div>"
              f"<section id=comments>nice {k}</section></article>" for k in range(4)]
    got = text_of(pages(spark, [*bodies, bodies[0], None, "", "<article></article>"]))
    for k in range(4):
        assert got[k] == f"Title {k} One bold&x é {shared} own{k} words more"
    assert got[4] == got[0] and got[5] == got[7] == ""


@pytest.mark.parametrize("wrap", [
    '<body class="has-sidebar">{}', '<body class="layout sidebar-right">{}', '<html class="cookie-ok"><body>{}', '<body><article class="post no-comments">{}</article>',
    '<body><main id="banner">{}</main>', '<body><div id="page" class="layout sidebar-right">{}</div>', '<body><form method="post" id="aspnet">{}</form>',
    '<head><meta charset="utf-8"><title>T</title><link rel="x" href="y"><body>{}', '<head><title>T</title>{}'])
def test_whole_pages_are_not_marked(wrap):
    """Classes of what holds the page, a form around it and a head that is not closed leave its text."""
    inner = '<div><p>{}</p></div><div class="cookie-notice">We use cookies</div><div class="post__share-buttons">Tweet</div><footer>us</footer>'
    words = " ".join(f"w{k}" for k in range(40))
    page = html.parse("<!DOCTYPE html>" + wrap.format(inner.format(words)))
    assert html.main_text(page, html.repeated([page])[0]) == words


def test_long_comments_beside_an_article_stay_marked():
    words, comments = " ".join(f"w{k}" for k in range(40)), " ".join(f"c{k}" for k in range(90))
    page = html.parse(f'<form><article><p>{words}</article><section id="comments">{comments}</section></form>')
    assert html.main_text(page, html.repeated([page])[0]) == words


def test_an_advert_is_marked_on_a_copy(spark):
    """An article that another page repeats still stands beside the words a marked element alone has."""
    words = " ".join(f"w{k}" for k in range(40))
    got = text_of(pages(spark, [f'<div class="ad">buy {k}</div><article>{words}</article>' for k in range(2)]))
    assert got == {0: words, 1: words}


def test_pages_that_declare_no_body(spark):
    """What the pages of a host share is told from what is their own."""
    shared = "Read all about our ten best offers of the season and subscribe today for more"
    bodies = [f"<div><p>{' '.join(f'p{k}w{i}' for i in range(40))}</p></div><div><p>{shared}</p></div>" for k in range(5)]
    got = text_of(pages(spark, bodies))
    assert all(got[k] == " ".join(f"p{k}w{i}" for i in range(40)) for k in range(5))


@pytest.mark.parametrize("n", [2, 3, 8])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_copies_with_a_line_of_their_own(spark, tag, n):
    """A print version or reposted copy keeps its text though its date line differs; what the host repeats still goes."""
    article = " ".join(f"w{k}" for k in range(60))
    shared = "Read all about our ten best offers of the season and subscribe today for more"
    bodies = [f"<div>day{k}</div><{tag}>{article}</{tag}><div>{shared}</div>" for k in range(n)]
    bodies += [f"<div><p>{' '.join(f'p{k}w{i}' for i in range(40))}</p></div><div>{shared}</div>" for k in range(30)]
    got = text_of(pages(spark, bodies))
    for k in range(n):
        assert got[k] == (article if tag == "article" else f"day{k} {article}") or got[k] == article
    assert all(got[n + k] == " ".join(f"p{k}w{i}" for i in range(40)) for k in range(30))


def test_two_copies_alone_on_a_host(spark):
    article = " ".join(f"w{k}" for k in range(60))
    got = text_of(pages(spark, [f"<p>day{k}</p><article>{article}</article>" for k in range(2)]))
    assert got == {0: article, 1: article}


def test_suffixes_find_every_repeat():
    rnd = random.Random(5)
    run = [f"r{k}" for k in range(12)]
    made = []
    for _ in range(12):
        own = [f"w{rnd.randrange(6)}" for _ in range(rnd.randrange(0, 40))] + (run[rnd.randrange(5):] if rnd.random() < 0.5 else [])
        made.append(html.Page([html.Block(own, (), False)] if own else [], []))
    lists = [[w for b in p.blocks for w in b.words] for p in made]
    where = {}
    for k, own in enumerate(lists):
        for i in range(len(own) - 7):
            where.setdefault(tuple(own[i:i + 8]), set()).add(k)
    for own, got in zip(lists, html.repeated(made), strict=True):
        want = {i + j for i in range(len(own) - 7) if len(where[tuple(own[i:i + 8])]) > 1 for j in range(8)}
        assert {int(i) for i in got.nonzero()[0]} == want


def test_hot_host_is_split(spark, monkeypatch):
    monkeypatch.setattr(html, "TOGETHER", 3)
    bodies = [f"<article><p>text of {k}</p></article>" for k in range(30)]
    got = text_of(pages(spark, bodies).union(pages(spark, bodies[:1], "b.example").withColumn("page_id", F.lit(99).cast("long"))))
    assert got == {k: f"text of {k}" for k in range(30)} | {99: "text of 0"}


def repeating(n, seed=3):
    """Pages without an article, their own words beside notices that some of them, many or all have."""
    rnd = random.Random(seed)
    notices = [" ".join(f"n{k}x{i}" for i in range(8 + k)) for k in range(6)]
    made = []
    for k in range(n):
        own = " ".join(f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(0, 60)))
        parts = [notices[j] for j in range(6) if rnd.random() < (1.0, 0.5, 0.2, 0.1, 0.05, 0.03)[j]]
        made.append("".join(f"<div><p>{part}</p></div>" for part in rnd.sample([own, *parts], 1 + len(parts))))
    return [*made, made[0], made[1], made[1]]


def test_a_split_host_gives_what_it_gives_unsplit(spark, monkeypatch):
    """What few pages of a host repeat is found whatever shares they are in, and counted over the whole host."""
    df = pages(spark, repeating(120)).union(pages(spark, repeating(4, 8), "b.example"))
    whole = collected(html.extract(df), "page_id", "text", "n_chars")
    for size in (2, 7, 60):
        monkeypatch.setattr(html, "TOGETHER", size)
        assert collected(html.extract(df), "page_id", "text", "n_chars") == whole


def test_a_notice_on_few_pages_of_a_split_host_goes(spark, monkeypatch):
    monkeypatch.setattr(html, "TOGETHER", 2)
    shared = "Read all about our ten best offers of the season and subscribe today for more"
    own = [" ".join(f"p{k}w{i}" for i in range(40)) for k in range(40)]
    bodies = [f"<div><p>{o}</p></div>" + (f"<div><p>{shared}</p></div>" if k % 13 == 0 else "") for k, o in enumerate(own)]
    assert text_of(pages(spark, bodies)) == dict(enumerate(own))


def test_runs_are_counted_whatever_they_are_packed_in():
    words = [[f"w{k % 5}" for k in range(30)], [], ["a"], [f"w{k % 5}" for k in range(9)], [f"v{k}" for k in range(8)]]
    where = {}
    for k, own in enumerate(words):
        for i in range(len(own) - 7):
            where.setdefault(tuple(own[i:i + 8]), set()).add(k)
    hashes, counts = html.on_pages(words)
    assert sorted(counts.tolist()) == sorted(len(on) for on in where.values())
    assert html.unpacked(html.packed(hashes)).tolist() == hashes.tolist() == sorted(set(hashes.tolist()))
    assert [len(a) for a in html.on_pages([])] == [0, 0] and html.unpacked(html.packed(hashes[:0])).tolist() == []
    page = html.parse("<main>a&nbsp;b\u2003c<div class=ad><p>x</div>\x1d y</main>")
    assert html.read(html.written(page)) == page and html.read(html.written(html.Page())) == html.Page()


@pytest.mark.parametrize("source", ["<", "<p", "<a b='", "</x></x>", "<p><p><b>a</p>b", "<div/>x", "<script>", "<!-- ", "&#x41;&bogus;", "a<br/>b", "\x00"])
def test_broken_pages_do_not_fail(source):
    page = html.parse(source)
    html.main_text(page, html.repeated([page])[0])


def test_odd_page_rows(spark):
    rows = [(None, None, "<p>a b</p>"), (1, "not a url", None), (1, "not a url", None), (2, "http://h/", "")]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert collected(got, "page_id", "text", "n_chars") == sorted([(None, "a b", 3), (1, "", 0), (1, "", 0), (2, "", 0)], key=repr)
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
