"""Operators with exact results, held against brute force; edge cases of each."""

import collections
import hashlib
import random
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

from immunoframe.llm import bpe, decontaminate, licenses, ngram_join, sharding, url_filter, warc
from immunoframe.llm.queries import URL_RULES

DOCS = "doc_id long, text string, lang string, source string, sid string, n int, token long, doc string, _t string, word string"


def docs_of(spark, pairs):
    """Documents with null columns and columns that bear names the operators use inside."""
    return spark.createDataFrame([(i, t, None, "s", "x", None, 1, "y", "z", None) for i, t in pairs], DOCS)


EDGES = [(1, None), (2, ""), (3, " \n\t "), (None, "null id"), (4, "one two three"), (4, "one two three"), (5, "W" * 50_000), (6, "a b c d e f g " * 4000), (7, "naïve Ünïcode ß 漢字 \u00a0 x")]


# --- 2 ------------------------------------------------------------------------------------------------

def brute_url(url, rules, default):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [(len(h) + len(p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else default


def test_url_filter(spark):
    rng = random.Random(2)
    hosts = ["com", "example.com", "EXAMPLE.com", "a.b.example.net", "notexample.com", "example.org", "net", "x.net.", "ä.net", ""]
    paths = ["", "/", "/en/", "/en/7", "/en/78?x=/de/", "/de/8#/en/", "/de/", "/es/9", "/EN/7", "/en"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(200)] + [None, "", "example.com/en/7", "://net/de/1", "http://a://net/de/", "x\ny://net/de/8"]
    df = spark.createDataFrame([(i, u, "allow", None) for i, u in enumerate(urls)], "page_id int, url string, verdict string, host string")
    own = [(r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df, "page_id", "url", URL_RULES).orderBy("page_id").collect()]
    want = [brute_url(u, URL_RULES, "allow") for u in urls]
    assert own == want
    parts = df.select("page_id", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    joined = url_filter.judge_by_join(parts, "page_id", spark.createDataFrame(URL_RULES, "verdict string, host string, path string"), "allow")
    assert [(r.host, r.path, r.rule, r.verdict) for r in joined.orderBy("page_id").collect()] == want
    assert url_filter.judge_urls(df.limit(0), "page_id", "url", URL_RULES).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(df, "page_id", "url", [], "block").collect()} == {"block"}


def test_repeated_rules_are_judged_alike_by_index_and_join(spark, monkeypatch):
    rules = [(v, f"h{i % 50}.com", f"/{i % 3}") for i, v in enumerate(random.Random(5).choices(["allow", "block"], k=600))]
    urls = [(i, f"http://a.h{i % 60}.com/{i % 4}x") for i in range(400)]
    df = spark.createDataFrame(urls, "page_id int, url string").repartition(7)
    known = {}
    for v, h, p in rules:
        known.setdefault((h, p), v)
    want = {i: brute_url(u, [(v, h, p) for (h, p), v in known.items()], "none")[3] for i, u in urls}
    by_index = {r.page_id: r.verdict for r in url_filter.judge_urls(df, "page_id", "url", rules, "none").collect()}
    monkeypatch.setattr(url_filter, "MAX_INDEX_BYTES", 1)
    assert by_index == want == {r.page_id: r.verdict for r in url_filter.judge_urls(df, "page_id", "url", rules, "none").collect()}


def test_a_collision_does_not_decide(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter, "digest", lambda h, p: 7)  # all strings share a digest
    (tmp_path / "i").write_bytes(url_filter.index_bytes([("block", "a.com", "/x"), ("allow", "b.com", "/")]))
    index = url_filter.DigestIndex(str(tmp_path / "i"))
    assert index.judge(["a.com", "b.com", "c.com"], ["/x", "/y", "/x"]) == [("block", "a.com", "/x"), ("allow", "b.com", "/"), None]


# --- 3 ------------------------------------------------------------------------------------------------

def test_sharding(spark):
    many = [(i, f"text {i}" * (i % 5)) for i in range(3000)]
    out = sharding.shard_rows(docs_of(spark, many + EDGES), "doc_id", "text", 24).collect()
    assert len(out) == 3000 + len(EDGES)
    own = dict(many)
    for r in out[:0] + [r for r in out if r.doc_id is not None and r.doc_id > 10]:
        assert r["size"] == len(own[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(own[r.doc_id].encode())
        best = max(range(24), key=lambda s: hashlib.md5(f"{r.doc_id}:{s}".encode()).hexdigest()[:13])
        assert r.shard == best and r.grown_shard in (best, 24)
    slots = collections.defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    moved = sum(r.shard != r.grown_shard for r in out)
    assert 0.5 < moved / (len(out) / 25) < 1.6
    nulls = [r for r in out if r["size"] == 8 and r.text_crc32 is None]
    assert len(nulls) == 1 and len({r.shard for r in out if r.doc_id == 4}) == 1
    assert sharding.shard_rows(docs_of(spark, EDGES).limit(0), "doc_id", "text", 24).count() == 0


def test_shards_take_rows_by_weight(spark):
    df = spark.range(8000).select(sharding.rendezvous(sharding.key_text(F.col("id")), [1.0, 3.0]).alias("s"))
    n = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    assert 2.6 < n[1] / n[0] < 3.4


# --- 5 ------------------------------------------------------------------------------------------------

def tokens(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def grams(w, k):
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute_leaks(docs, items):
    out = {}
    for i, t in docs:
        for j, s in items:
            own = tokens(s)
            k = min(5, len(own))
            if k:
                a = grams(own, k)
                shared = len(a & grams(tokens(t), k))
                if shared * 100 >= len(a) * 80:
                    out[i, j] = max(out.get((i, j), 0), shared)
    return out


def test_decontamination(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("aeiou") + rng.choice("lmnrst")
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 4, 5, 6, 9, 20, 40, 70])))) for i in range(40)] + [(100, None), (101, "..."), (102, "same item twice over here"), (103, "same item twice over here")]
    docs = list(EDGES)
    for i in range(100, 180):
        text = [word() for _ in range(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 3)):
            w = tokens(rng.choice(items[:40])[1])
            for _ in range(rng.randint(0, 3)):  # some words changed, so the containment lies on either side
                w[rng.randrange(len(w))] = word()
            at = rng.randint(0, len(text))
            text[at:at] = [x.upper() if rng.random() < 0.2 else x for x in w]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(text)))
    docs.append((200, "And SAME item, twice over here."))
    it = spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, doc string")
    got = {(r.doc_id, r.item_id): r.n_shared for r in decontaminate.leaks(docs_of(spark, docs), it).collect()}
    want = brute_leaks(docs, items)
    assert got == want and len(want) > 40 and (200, 103) in want
    kept = decontaminate.drop_leaks(docs_of(spark, docs), it)
    bad = {i for i, _ in want}
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(i for i, _ in docs if i not in bad) and kept.columns == docs_of(spark, docs).columns
    assert decontaminate.leaks(docs_of(spark, docs).limit(0), it).count() == 0
    assert decontaminate.leaks(docs_of(spark, docs), it.limit(0)).count() == 0


def test_leaks_are_dropped_by_row(spark):
    items = spark.createDataFrame([(1, "seven wise owls sat in the old oak tree")], "item_id long, text string")
    leak, clean = "they say seven wise owls sat in the old oak tree today", "cold rain fell on the grey roofs all night"
    docs = [(None, leak), (None, clean), (None, None), (7, leak), (7, clean), (8, clean), (9, leak)]
    got = [(r.doc_id, r.text) for r in decontaminate.drop_leaks(docs_of(spark, docs), items).collect()]
    assert sorted(got, key=repr) == sorted([d for d in docs if d[1] != leak], key=repr)


# --- 7 ------------------------------------------------------------------------------------------------

def brute_licenses(docs, templates=licenses.TEMPLATES):
    """Every span of every text against every template."""
    grams = lambda w: [tuple(w[i : i + 2]) for i in range(len(w) - 1)]
    known = [(i, set(grams(tokens(t)))) for i in sorted(templates) for t in templates[i]]
    out = []
    for key, text in docs:
        own, best = grams(tokens(text or "")), {}
        for name, b in known:
            places = [i for i, g in enumerate(own) if g in b]
            if len({own[i] for i in places}) < len(b) * 0.8 / 1.2 - 1e-9:
                continue
            for s in places:
                for e in (x for x in places if s <= x < s + int(len(b) * 1.5 + 1e-9)):
                    span = own[s : e + 1]
                    shared = {g for g in span if g in b}
                    dice = round(2 * len(shared) / (sum(g not in b for g in span) + len(shared) + len(b)), 6)
                    if dice >= 0.8:
                        best[s] = min((-dice, s - e, name), best.get(s, (1, 0, "")))
        spans = [(d, n - 2, s, name) for s, (d, n, name) in best.items()]
        for d, n, s, name in spans:
            if not any((e, o, t) < (d, n, s) and s < t - o and t < s - n for e, o, t, _ in spans):
                out.append((key, name, s, -n, -d))
    return collections.Counter(out)


def test_license_scan(spark):
    long, whole = licenses.TEMPLATES["MIT"][2], licenses.TEMPLATES["MIT"][3]
    wrapped = lambda t, n: "\n * ".join(" ".join(t.split()[i : i + n]) for i in range(0, len(t.split()), n))
    filler = "some other words that stand around it "
    docs = [*EDGES, (20, "x\nReleased under the MIT License.\nReleased  under the mit license\ny"), (21, "Licensed under CC BY 4.0"), (22, long.replace(" ", "\n", 9)), (23, "Released under the BSD MIT License."),
            (24, "This work is licensed under the GNU General Public License, version 2."), (25, "Licensed under the Apache License, Version 2.0. and more words that make it another line altogether"),
            (26, filler * 30 + wrapped(long, 8) + "\n" + filler * 30), (27, wrapped(whole, 11)), (28, filler + whole + filler + licenses.TEMPLATES["Zlib"][0] + "\n" + licenses.TEMPLATES["BSD-3-Clause"][2]),
            (29, "of the software " * 400), (30, "Released under the MIT License. " * 50), (30, wrapped(licenses.TEMPLATES["ISC"][1], 10)), (None, licenses.TEMPLATES["0BSD"][0])]
    got = collections.Counter(map(tuple, licenses.scan(docs_of(spark, docs)).collect()))
    want = brute_licenses(docs)
    assert got == want
    names = lambda key: [n for (k, n, *_), m in sorted(want.items(), key=repr) if k == key for _ in range(m)]
    assert [names(k) for k in (20, 21, 22, 24, 25, 26, 27, 29)] == [["MIT", "MIT"], ["CC-BY-4.0"], ["MIT"], ["GPL-2.0"], ["Apache-2.0"], ["MIT"], ["MIT"], []]
    assert sorted(names(28)) == ["BSD-3-Clause", "MIT", "Zlib"] and sorted(names(30)) == ["ISC"] + ["MIT"] * 50 and names(None) == ["0BSD"]
    assert licenses.scan(docs_of(spark, docs).limit(0)).count() == 0


def test_license_recall_on_altered_notices(spark):
    """Notices wrapped at any width inside longer texts; of those of ten words or more one word in twenty is changed, added or left out.

    A change in a shorter one takes it below the threshold by itself.
    """
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    altered = lambda w, u: [word()] if u < 0.02 else [] if u < 0.035 else [w, word()] if u < 0.05 else [w]
    docs, want = [], {}
    for name, texts in sorted(licenses.TEMPLATES.items()):
        for t in texts:
            for _ in range(6):
                own = [x for w in t.split() for x in altered(w, rng.random() if len(t.split()) >= 10 else 1.0)]
                n = rng.randint(5, 20)
                body = [word() for _ in range(rng.randint(0, 200))] + own + [word() for _ in range(rng.randint(0, 200))]
                want[len(docs)] = name
                docs.append((len(docs), "\n".join(" ".join(body[i : i + n]) for i in range(0, len(body), n))))
    docs += [(10_000 + i, " ".join(word() for _ in range(300))) for i in range(50)]
    found = {(r.doc_id, r.license_id) for r in licenses.scan(docs_of(spark, docs)).collect()}
    recall = sum((k, n) in found for k, n in want.items()) / len(want)
    print("recall", recall, len(want))
    assert recall >= 0.9 and all(k < 10_000 for k, _ in found)


def test_license_sql(spark):
    import duckdb

    from immunoframe.llm import queries as llm

    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = con.sql(llm.oracle_sql()["op7_license_scan"])
    own = llm.queries()["op7_license_scan"](spark, "/root/testdata/sf0.001")
    assert own.columns == want.columns and sorted(map(repr, map(tuple, own.collect()))) == sorted(map(repr, want.fetchall())) != []


# --- 8 ------------------------------------------------------------------------------------------------

def sets_of(docs):
    out = []
    for i, t in docs:
        w = (t or "").encode().lower().split()
        out.append((i, frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    return out


def brute_components(docs):
    own = sets_of(docs)
    root = list(range(len(own)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(own)):
        for b in range(a):
            x, y = own[a][1], own[b][1]
            if x and y:
                k = len(x & y)
                if 100 * k >= 80 * (len(x) + len(y) - k):
                    root[find(a)] = find(b)
    low = {}
    for a in range(len(own)):
        ids = low.setdefault(find(a), [])
        ids.append(own[a][0])
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    return sorted(((i, len(s), least(low[find(a)]) if s else i) for a, (i, s) in enumerate(own)), key=repr)


def near_copies(rng, n_groups=14):
    """Groups of copies with changed words: chains in which only neighbours link, hubs, copies, and unrelated texts that share passages."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    passage = [word() for _ in range(40)]
    docs = []
    for g in range(n_groups):
        base = [word() for _ in range(rng.choice([3, 5, 8, 30, 60, 200]))]
        for _ in range(rng.randint(1, 14)):
            if rng.random() < 0.5:
                base = list(base)
            own = list(base)
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(len(own))] = word()
            if rng.random() < 0.4:
                base = own  # the next one is a copy of this one: similarity drifts
            if rng.random() < 0.3:
                own = own + passage
            docs.append(" ".join(own))
    docs += [" ".join(passage + [word() for _ in range(rng.randint(1, 60))]) for _ in range(20)]
    docs += rng.sample(docs, 15)
    rng.shuffle(docs)
    return list(enumerate(docs, 1000))


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join(spark, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)  # the way for many documents
    docs = near_copies(random.Random(seed)) + EDGES
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.components(docs_of(spark, docs)).collect()), key=repr)
    want = brute_components(docs)
    assert got == want and sum(i != c for i, _, c in want) > 30


def test_hot_shingles_are_dealt_and_kept(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT", 4)
    docs = near_copies(random.Random(7), 8)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.components(docs_of(spark, docs)).collect()), key=repr)
    assert got == brute_components(docs)


def test_a_family_near_the_limit(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base, docs = [word() for _ in range(150)], []
    for _ in range(70):  # of lengths and changes that put pairs on either side of 0.8, and some in groups of their own
        own = list(base[: rng.randint(110, 150)])
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(len(own))] = word()
        docs.append((len(docs), " ".join(own)))
    want = brute_components(docs)
    assert 1 < len({c for _, _, c in want}) < 40
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.components(docs_of(spark, docs).repartition(5)).collect()), key=repr)
    assert got == want


def test_parities_bound_the_difference():
    rng = random.Random(4)
    for _ in range(200):
        a = [rng.getrandbits(64) for _ in range(rng.randint(1, 400))]
        b = a[: rng.randint(0, len(a))] + [rng.getrandbits(64) for _ in range(rng.randint(0, 100))]
        x, y = (ngram_join.np.unique(ngram_join.np.array(v or [1], ngram_join.np.uint64)) for v in (a, b))
        differ = len(set(x.tolist()) ^ set(y.tolist()))
        u, v = (ngram_join._parities(w).view(ngram_join.np.uint64) for w in (x, y))  # numpy counts the bits of a signed number's absolute value
        assert int(ngram_join.np.bitwise_count(u ^ v).sum()) <= differ
        fold = lambda w: ngram_join.np.bitwise_xor.reduce(w.reshape(-1, len(ngram_join.FOLDED)), axis=0)
        assert int(ngram_join.np.bitwise_count(fold(u) ^ fold(v)).sum()) <= differ


def test_one_of_each(spark):
    docs = near_copies(random.Random(3), 6) + EDGES
    frame = docs_of(spark, docs)
    kept = ngram_join.one_of_each(frame)
    assert kept.columns == frame.columns
    groups = {(c if n else ("none", i)) for i, n, c in brute_components(docs)}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(map(repr, got)) == sorted(repr(i) for i in [*[g for g in groups if not isinstance(g, tuple)], *[i for i, t in docs if not (t or "").split()]])
    assert ngram_join.one_of_each(frame.limit(0)).count() == 0


def test_one_of_each_group_with_null_and_repeated_ids(spark):
    texts = ["the quick brown fox jumps over a lazy dog", "seven wise owls sat in the old oak tree", "cold rain fell on the grey roofs all night"]
    docs = [(None, t) for t in texts] + [(None, texts[0])] + [(8, "a first text under the id eight here"), (8, "quite another text that has the same id"), (9, texts[1])]
    got = [(r.doc_id, r.text) for r in ngram_join.one_of_each(docs_of(spark, docs)).collect()]
    assert sorted(got, key=repr) == sorted([(None, texts[0]), (9, texts[1]), (None, texts[2]), *docs[4:6]], key=repr)


# --- 9 ------------------------------------------------------------------------------------------------

def test_warc_round_trip(spark):
    pages = [(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (3, None, None), (4, "u\r\nv", ""), (5, "http://c/", "é" * 200_000), (6, "", "WARC/1.1\r\n\r\n"), (7, "u", "\x1f\x8b\x08")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string")
    out = {r.page_id: r for r in warc.round_trip(df).collect()}
    assert len(out) == 7 and all(out[i].payload_bytes == len((h or "").encode()) and out[i].payload_digest == warc.base32_sha1((h or "").encode()) for i, _, h in pages)
    assert (out[1].record_type, out[1].refers_to, out[2].record_type, out[2].refers_to) == ("revisit", 2, "response", None)
    assert (out[3].refers_to, out[4].record_type) == (4, "response")
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_digests_are_worked_out_anew_and_gaps_are_logged(spark, tmp_path):
    good = [warc.gzip_member(warc.record_bytes("response", {"Page-Id": str(i)}, b"x" * i)) for i in range(20)]
    bad = bytearray(good[7])
    bad[-9] ^= 0xFF
    (tmp_path / "part-0").write_bytes(b"".join([*good[:7], bytes(bad), *good[8:]]))
    found = warc.read_warc(spark, str(tmp_path))
    at = len(b"".join(good[:7]))
    assert [(r["at"], r["end"]) for r in warc.quarantine(found).collect()] == [(at, at + len(bad))]
    assert all(r.payload_digest == warc.base32_sha1(r.payload) for r in found.where("gap is null").collect()) and found.where("gap is null").count() == 19


def test_reading_an_archive_takes_time_in_proportion():
    rng = random.Random(8)
    block = [warc.gzip_member(warc.record_bytes("response", {}, rng.randbytes(20_000))) for _ in range(50)]
    def seconds(times):
        whole, began = b"".join(block * times), time.process_time()
        assert sum(1 for _ in warc.salvage(whole)) == 50 * times
        return time.process_time() - began
    seconds(2)
    assert seconds(80) < 14 * seconds(10) + 0.5  # 80 and 10 MB


@pytest.mark.parametrize("zipped", [True, False])
def test_salvage(zipped):
    rng = random.Random(6)
    records = [warc.record_bytes("response", {"Page-Id": str(i)}, bytes(rng.randrange(256) for _ in range(rng.randint(0, 300)))) for i in range(30)]
    parts = [warc.gzip_member(r) if zipped else r for r in records]
    whole = b"".join(parts)
    assert [f.headers["Page-Id"] for f in warc.salvage(whole)] == [str(i) for i in range(30)]
    for trial in range(40):
        bad = sorted(rng.sample(range(30), 3))
        broken = list(parts)
        for k in bad:
            p = bytearray(broken[k])
            how = rng.randrange(3)
            if how == 0:
                at = rng.randrange(len(p) - 8)
                p[at : at + 8] = bytes(x ^ 0x55 for x in p[at : at + 8])
            elif how == 1:
                p = p[: len(p) // 2]
            else:
                p = bytearray(b"junk") + p[3:]
            broken[k] = bytes(p)
        raw = b"".join(broken)
        found = list(warc.salvage(raw))
        got = [f.headers.get("Page-Id") for f in found if not f.gap]
        want = [str(i) for i in range(30) if i not in bad]
        assert [g for g in got if g in want] == want, (trial, bad)  # a plain record's header has no digest and may come back damaged
        assert (any(f.gap for f in found) or not zipped) and [f.at for f in found[1:]] == [f.end for f in found[:-1]] and found[0].at == 0 and found[-1].end == len(raw)
    assert list(warc.salvage(b"")) == [] and [f.gap != "" for f in warc.salvage(b"garbage")] == [True]


def test_salvage_of_plain_archives_with_gzip_payloads():
    payloads = [b"plain", warc.gzip_member(b"<p>an HTTP body</p>"), b"more", b"last"]
    parts = [warc.record_bytes("response", {"Page-Id": str(i)}, p) for i, p in enumerate(payloads)]
    ids = lambda raw: [f.headers["Page-Id"] for f in warc.salvage(raw) if not f.gap]
    assert ids(b"".join(parts)) == ["0", "1", "2", "3"]
    late = [parts[0], parts[2], warc.record_bytes("response", {"Page-Id": "4"}, b"x" * 5000), parts[1], parts[3]]
    assert ids(b"junk" + b"".join(late)[4:]) == ["2", "4", "1", "3"]
    mixed = [parts[0], warc.gzip_member(parts[1]), parts[2], warc.gzip_member(parts[3])]
    assert ids(b"".join(mixed)) == ["0", "1", "2", "3"]
    mixed[1] = mixed[1][:20]
    assert ids(b"".join(mixed)) == ["0", "2", "3"]


def test_members_beyond_the_length_field(monkeypatch):
    big = warc.record_bytes("response", {"Page-Id": "1"}, b"x" * ((1 << 24) + 5))
    m = warc._member(big)
    assert m.endswith(b"\0") and [f.payload for f in warc.salvage(m)] == [b"x" * ((1 << 24) + 5)]


def test_archives_as_others_write_them(spark, tmp_path):
    record = lambda i, digest="": f"WARC/1.0\r\nwarc-type: response\r\nPage-Id: {i}\r\nWARC-Target-URI: http://a/\r\n  b\r\ncontent-length: 3\r\n{digest}\r\nab{i}\r\n\r\n".encode()
    hexed = hashlib.sha1(b"ab3").hexdigest()
    good = [record(0), record(1, "WARC-Block-Digest: md5:00\r\n"), record(3, f"WARC-BLOCK-DIGEST: SHA1:{hexed}\r\n")]
    (tmp_path / "crawl-1.warc.gz").write_bytes(warc.gzip_member(b"".join(good)) + warc.gzip_member(record(4)))
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "crawl-2.warc").write_bytes(record(5) + record(6))
    (tmp_path / "notes.txt").write_bytes(b"no archive")
    found = warc.read_warc(spark, str(tmp_path), "*.warc*").collect()
    assert all(r.gap is None and r.payload == b"ab" + r.headers["Page-Id"].encode() and r.headers["WARC-Target-URI"] == "http://a/ b" for r in found)
    assert sorted((r.headers["Page-Id"], r.inside) for r in found) == [("0", 0), ("1", len(good[0])), ("3", len(good[0] + good[1])), ("4", 0), ("5", None), ("6", None)]
    assert warc.read_warc(spark, str(tmp_path)).where("gap is not null").count() == 1
    bad = record(3, f"WARC-Block-Digest: sha1:{'0' * 40}\r\n")
    member = warc.gzip_member(record(0) + bad + record(1))
    assert [(f.gap, f.headers and f.headers["Page-Id"], f.inside) for f in warc.salvage(member)] == [("", "0", 0), ("block digest", None, len(record(0))), ("", "1", len(record(0) + bad))]


def test_a_record_within_a_damaged_one_is_marked():
    inner = warc.record_bytes("response", {"Page-Id": "99"}, b"quoted")
    outer = warc.record_bytes("response", {"Page-Id": "1"}, b"before " + inner + b" after")
    late = warc.record_bytes("response", {"Page-Id": "2"}, b"x")
    found = [(f.headers["Page-Id"], f.inner) for f in warc.salvage(outer[:-2] + b"??" + late) if not f.gap]
    assert found == [("99", True), ("2", False)]
    assert [(f.headers["Page-Id"], f.inner) for f in warc.salvage(outer + late)] == [("1", False), ("2", False)]
    cut = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Le"
    assert [f.headers["Page-Id"] for f in warc.salvage(cut + late + b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 12" + late) if not f.gap] == ["2", "2"]


def test_damage_takes_time_in_proportion():
    for piece in (b"WARC/1.1\r\n", b"WARC/1.1\r\na: b\r\n WARC/1.1\r\n", b"WARC/1.1\r\na: b\r\n\r\n", b"a: b\r\n", b"x: WARC/1.1\r\n", b" WARC/1.1\r\n\r\n"):
        raw = b"WARC/1.1\r\n" + piece * ((16 << 20) // len(piece))
        began = time.process_time()
        assert all(f.gap for f in warc.salvage(raw))
        assert time.process_time() - began < 30, piece


def test_warc_round_trip_of_odd_ids_and_large_pages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 20)
    large = "".join(random.Random(4).choices("abcdefghijklmnop", k=4_000_000))
    pages = [(None, "u", "alone"), (None, "u", "twice"), (None, "u", "twice"), (1, "u", "both"), (None, "u", "both"), (5, "u", "same"), (5, "v", "same"), (6, "w", "one"), (6, "w", "other"), (8, "x", large), (9, "x", large), *[(i, "y", large[i:]) for i in range(10, 16)]]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, volume string").coalesce(1)
    log = f"file://{tmp_path}/gaps"
    out = warc.round_trip(df, log).collect()
    assert sorted((repr(r.page_id), r.payload_bytes, r.payload_digest) for r in out) == sorted((repr(i), len(h), warc.base32_sha1(h.encode())) for i, _, h in pages)
    kinds = collections.Counter((r.page_id, r.record_type, r.refers_to) for r in out if r.page_id not in range(10, 16))
    assert kinds == collections.Counter({(None, "response", None): 3, (1, "response", None): 1, (None, "revisit", 1): 1, (5, "response", None): 2, (6, "response", None): 2, (9, "response", None): 1, (8, "revisit", 9): 1})
    assert spark.read.parquet(log).count() == 0


# --- 10 -----------------------------------------------------------------------------------------------

def test_bpe(spark):
    from tokenizers import Tokenizer

    rng = random.Random(8)
    alphabet = "ab 'sé\n\t  ß1<|endoftext|>  漢don't!"
    passage = "".join(rng.choice(alphabet) for _ in range(3000))
    docs = [*EDGES, *[(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 400))) + passage + "z" * rng.choice([0, 1, 30_000])) for i in range(20, 40)], (50, "a<|endoftext|>b")]
    own = Tokenizer.from_file(bpe.default_path())
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs_of(spark, docs)).collect()), key=repr)
    want = []
    for i, t in docs:
        ids = own.encode(t or "", add_special_tokens=False).ids
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(own.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    full = bpe.encode_rows(docs_of(spark, docs), keep=["doc_id"]).collect()
    assert {(r.doc_id, r.decoded) for r in full} == {(i, t or "") for i, t in docs}
    assert bpe.digests(docs_of(spark, docs).limit(0)).count() == 0


def test_bpe_reuses_and_repairs():
    c = bpe.Codec(bpe.default_path(), cache_bytes=1 << 20)
    rng = random.Random(1)
    shared = " ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(1, 9))) for _ in range(2000))
    for k in range(30):
        c.encode(f"{'x' * k} {shared} {k}".encode())
    assert c.hits > 5 * c.misses and c.repairs and c._held <= 1 << 20
