"""Main text, source divergence and fill-in-middle: brute force, hand-worked pages, exact round trips; edge cases of each."""

import collections
import hashlib
import itertools
import random
import re
import time
from html.parser import HTMLParser
from pathlib import Path

import pytest

from immunoframe.llm import divergence, fim, main_text
from immunoframe.llm import queries as llm

DATA = Path("/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, term string, n int, output string, _k string, value long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, la, so, 1, "x", None, "y", "z", 3) for i, t, la, so in rows], DOCS)


EDGES = [
    (1, None, "en", "s"), (2, "", None, None), (3, " \n\t ", "en", "s"), (None, "null id\nx", "en", "s"), (4, "one two\nthree", "xx", "y"), (4, "one two\nthree", "xx", "y"),
    (5, "W" * 3_000_000, "en", "s"), (6, "a b c d e f g\n" * 60_000, "en", None), (7, "naïve Ünïcode ß 漢字 \U0001f600\n  x", "de", "s"), (8, "\n\n\n", "en", "s"), (9, "has <M> in it", "en", "s")]


@pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")
@pytest.mark.parametrize("name", ["op11_main_text", "op12_source_divergence", "op13_fill_in_middle"])
def test_same_rows_as_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    other = con.sql(llm.oracle_sql()[name])
    own = llm.queries()[name](spark, str(DATA))
    assert own.columns == other.columns
    assert sorted(map(repr, map(tuple, own.collect()))) == sorted(map(repr, other.fetchall())) != []


# --- 11 -----------------------------------------------------------------------------------------------

PROSE = "The committee met on Tuesday and heard from several residents about the new bridge. It will open in spring."
TABLE = "page_id long, url string, html string, text string, n_chars long, _h string"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "t", 4, "h") for i, u, h in rows], TABLE)


class Plain(HTMLParser):
    """The text of the article element by another parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in ("p", "br", "h1"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag in ("p", "h1"):
            self.out.append(" ")

    def handle_data(self, data):
        if self.inside:
            self.out.append(data)


@pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")
def test_main_text_against_another_parser(spark):
    pages = spark.read.parquet(str(DATA / "pages.parquet"))
    own = {r.page_id: (r.text, r.n_chars) for r in llm.queries()["op11_main_text"](spark, str(DATA)).collect()}
    assert len(own) == pages.count()
    for r in pages.collect():
        p = Plain()
        p.feed(r.html)
        p.close()
        want = " ".join("".join(p.out).split())
        assert own[r.page_id] == (want, len(want))


LAYOUTS = {
    "no names": ("<html><body><div><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li><li><a>Sport</a></li></ul></div><div><h1>A bridge</h1><p>{0}</p><p>{0}</p></div>"
                 "<div><a>About</a> <a>Legal</a></div>", "A bridge {0} {0}"),
    "classes": ('<body class="has-sidebar"><div id="cookie-banner">We use cookies to make this site work for you, as you know.</div><div class="site-header">The Daily</div>'
                '<div class="post"><h1>A bridge</h1><p>{0}<div class="ad-slot">Buy one today and get another free of charge</div><p>{0}</div>'
                '<div class="sidebar"><p>{0}</p></div><ol class="commentList"><li>I do not agree with any of this at all</li></ol><div class=pageFooter>All rights reserved</div>',
                "A bridge {0} {0}"),
    "article": ('<header>The Daily</header><nav><a>Home</a></nav><p>Please subscribe to our letter, it is free and comes once a week, and never more often than that.</p>'
                '<article><header><h1>A bridge</h1></header><p>{0}<ul><li>one</li><li><a>two</a></li></ul><form>Your mail <input><button>Send</button></form>'
                '<aside>More on bridges</aside><p>End.<section id=comments><p>{0}</p></section></article><section class="related">Other news of the day</section><footer>Imprint</footer>',
                "A bridge {0} one two End."),
    "references": ("<article>caf&eacute; &lt;b&gt; &#8364;&#x41;&nbsp;&amp;amp; a<b>b</b>c<br>d\n\t e<script>var x='<p>no</p>'</script><style>p{{}}</style><!-- <p>no</p> -->"
                   "<p hidden>no</p><p style='display: none'>no</p>", "café <b> €A &amp; abc d e"),
    "quoted": ('<article data-x="a > b" title=\'</article>\'><p title="x>y">{0}</p></article><footer>{0}</footer>', "{0}"),
    "cut in a tag": ("<article><p>{0}</p><p>end <a href='x", "{0} end"),
    "cut in a script": ("<article><p>{0}</p><script>var a = '<p>no", "{0}"),
    "stray ends": ("</div></p></article><article></ul><p>{0}</b></p></section></article></body>", "{0}"),
    "bare text": ("{0}", "{0}"),
    "only a menu": ("<nav><a>Home</a></nav>", ""),
    "empty": ("", ""),
}


def test_main_text_of_hand_worked_pages(spark):
    rows = [(i, f"http://a/{i}", h.format(PROSE)) for i, (h, _) in enumerate(LAYOUTS.values())] + [(None, None, None), (3, "http://a/3", "<p>again</p>"), (3, "http://a/3", "<p>again</p>")]
    learned = [(100 + i, f"http://b/{i}", f"<body><nav><ul><li><a>Home</a></li></ul></nav><article><h1>Title</h1><p>{PROSE}</p></article><footer>Imprint of the page</footer>") for i in range(30)]
    for extra in ([], learned):  # with customs alone, and with labelled pages beside them
        got = collections.Counter((r.page_id, r.text) for r in main_text.main_texts(pages_of(spark, rows + extra)).collect() if (r.page_id or 0) < 100)
        want = collections.Counter((i, t.format(PROSE)) for i, (_, t) in enumerate(LAYOUTS.values())) + collections.Counter([(None, ""), (3, "again"), (3, "again")])
        assert got == want
    out = main_text.main_texts(pages_of(spark, rows))
    assert out.columns == ["page_id", "url", "text", "n_chars"] and all(r.n_chars == len(r.text) for r in out.collect())
    assert main_text.main_texts(pages_of(spark, []).limit(0)).count() == 0


def test_weights_come_from_labelled_pages():
    page = "<body><div class='zq'>{0}</div><article><div class='kx'>{0} {0}</div></article>".format(PROSE)
    counts = sum((main_text.tally(page) for _ in range(40)), collections.Counter())
    w = main_text.weights_of(counts)
    assert w.of(".zq") < -5 and w.of(".kx") > 5 and w.of(".unseen") == 0
    assert main_text.extract(f"<div class='zq'>{PROSE} {PROSE}</div><div class='kx'>Short text.</div>", w) == "Short text."


def test_best_run_against_all_runs():
    rng = random.Random(3)
    for _ in range(300):
        s = [rng.randint(-4, 4) for _ in range(rng.randint(0, 9))]
        runs = [(sum(s[a:b]), a, b) for a, b in itertools.combinations(range(len(s) + 1), 2)]
        begin, end = main_text.best_run(s)
        best = max([0, *(r[0] for r in runs)])
        assert sum(s[begin:end]) == best and ((begin, end) == (0, 0)) == (best == 0)


def test_pages_are_read_in_linear_time():
    w = main_text.Weights({}, {})
    for piece in ("<a ", '<a "', "<!--", "<script>", "<div class=x>", "<p", "&", "</p ", "<b><i>", "< ", "<a b='", "\x00<", "<li><ul>", "<a =\"<a ='", "=\"", "<a b=c d='e' "):
        took = []
        for n in (20_000, 160_000):
            began = time.process_time()
            main_text.extract(piece * (n // len(piece)), w)
            took.append(time.process_time() - began)
        assert took[1] < 30 * max(took[0], 0.01), (piece, took)


# --- 12 -----------------------------------------------------------------------------------------------

def brute_audit(rows, min_docs, top):
    docs = [(la or "", so or "", [t.translate({c: c + 32 for c in range(65, 91)}) for t in re.findall(r"[A-Za-z\x80-\U0010ffff]+", x or "")]) for _, x, la, so in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        counts = {s: collections.Counter(t for d in own if d[1] == s for t in d[2] if df[t] >= min_docs) for s in {d[1] for d in own}}
        whole = sum(counts.values(), collections.Counter())
        share = lambda c, t: 1 + (10**9 * (c[t] + 5)) // (sum(c.values()) + 5 * len(kept))
        for s, c in counts.items():
            pairs = [(sum(abs(share(c, t) - share(o, t)) for t in kept), i) for i, o in counts.items() if i != s]
            terms = [(share(c, t) - share(whole, t), t) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, i, v, k + 1) for k, (v, i) in enumerate(found[:most])}
    return out


def test_source_divergence(spark, monkeypatch):
    rng = random.Random(12)
    words = ["alpha", "Beta", "ΓΆΜΑ", "delta's", "x1y", "zeta", "ñu", "\U0001f600", "the", "THE", "Ä", "rare"]
    rows = [(i, " ".join(rng.choices(words, [9, 8, 7, 6, 5, 4, 3, 2, 40, 20, 1, 0.05], k=rng.randint(0, 30))), rng.choice(["en", "en", "fr", None]), rng.choice(["a", "b", "c", None, "é"])) for i in range(400)]
    rows += EDGES + [(20, "123", "only", "one"), (21, "", "en", "wordless")]
    for min_docs, top, held in ((30, 50, 200_000), (1, 3, 5)):
        monkeypatch.setattr(divergence, "HELD", held)
        out = divergence.audit(docs_of(spark, rows), min_docs, top)
        assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
        got = [tuple(r) for r in out.collect()]
        assert len(got) == len(set(got)) and set(got) == brute_audit(rows, min_docs, top)
    assert divergence.audit(docs_of(spark, rows).limit(0)).count() == 0
    monkeypatch.setattr(divergence, "MAX_GROUPS", 3)
    with pytest.raises(ValueError, match="groups"):
        divergence.audit(docs_of(spark, rows))


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, kept = 5 * 10**12 + 3, 9 * 10**14 + 7, 10**7
    df = spark.createDataFrame([(n, total, kept)], "n long, t long, v long")
    want = 1 + 10**9 * (n + 5) // (total + 5 * kept)
    assert df.select(divergence.share(df.n, df.t, df.v)).first()[0] == want
    vectors = spark.createDataFrame([("en", [("a", n), ("b", 1)], 2)], "lang string, vector array<struct<source:string,n:long>>, times long")
    got = divergence._pair_sums(vectors, {"en": (["a", "b"], [total, 3], kept)}).first()
    assert got.value == 2 * abs(want - (1 + 10**9 * 6 // (3 + 5 * kept)))


# --- 13 -----------------------------------------------------------------------------------------------

def brute_fim(key, text):
    text = text or ""
    units = text.splitlines(keepends=True) if not re.search(r"[\r\x0b\x0c\x1c-\x1e\x85  ]", text) else re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'null' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "plain" if not text or re.search("<[PSM]>", text) else "spm" if h4 % 100 < 50 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    return (key, len(units), form, *((None, None) if form == "plain" else (len(p), len(m)))), out, text


def test_fill_in_middle(spark):
    rng = random.Random(13)
    rows = [(i, "".join(rng.choice(["a line\n", "\n", "x", "<", "P>", "é ü\n", "\r\n"]) for _ in range(rng.randint(0, 12))), "en", "s") for i in range(30, 400)] + EDGES
    docs = docs_of(spark, rows)
    want = collections.Counter((*a, hashlib.sha256(o.encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for a, o, t in (brute_fim(i, t) for i, t, _, _ in rows))
    got = fim.digests(docs)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert collections.Counter(map(tuple, got.collect())) == want
    whole = fim.fill_in_middle(docs)
    assert whole.columns == [*docs.columns, "fim"]
    for r in whole.collect():
        assert fim.restore(r.fim.output, r.fim.form) == (r.text or "")
    assert {r.fim.form for r in whole.collect()} == {"plain", "psm", "spm"}
    assert fim.digests(docs.limit(0)).count() == 0 and fim.fill_in_middle(docs.limit(0)).count() == 0


def test_fill_in_middle_parameters(spark):
    rows = [(i, "one\ntwo\nthree\n", "en", "s") for i in range(600)]
    forms = collections.Counter(r.fim.form for r in fim.fill_in_middle(docs_of(spark, rows), rule=fim.Rule(seed=1, rate=50, spm=10)).collect())
    assert 240 < forms["plain"] < 360 and forms["spm"] < forms["psm"] / 4
    words = fim.fill_in_middle(docs_of(spark, rows[:5]), rule=fim.Rule(unit=r"\S+\s*")).collect()
    assert all(r.fim.n == 3 for r in words)
    with pytest.raises(ValueError):
        fim.restore("<S>a<M>b", "psm")
