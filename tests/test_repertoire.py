"""Hand-worked cases of decoders, groups, consensus, anchors, V(D)J, clones, records and sources."""

import itertools
import json
import random
import re
import sqlite3

import numpy as np
import pytest
from pyspark.sql import functions as F

from immunoframe.functions import sequence as S
from immunoframe.operators import align, anchors, barcodes, clones, components, consensus, filters, groups, runmeta, vdj
from immunoframe.plans import pipelines, queries
from immunoframe.sources import metadata, sequences


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


@pytest.mark.parametrize(("lengths", "kept"), [
    ([510, 520, 530, 540, 900], 4), ([510, 910, 520, 920, 700], 2), ([910, 510, 520, 920, 700], 2), ([10, 20, 30, 80, 90], 0), ([1, 2, 3, 900], 4)])
def test_adaptive_filter(spark, lengths, kept):
    df = spark.createDataFrame([(i, "g", n) for i, n in enumerate(lengths)] + [(99, None, 5)], "o int, g string, len int")
    out = groups.adaptive_filter(df, "g", "len", "o", 100, 0.10, 5).collect()
    assert {r.n_orig for r in out} == {len(lengths)} and {r.n_keep for r in out} == {kept} and sum(r.kept for r in out) == kept


def test_peak_tie_goes_to_the_first_seen(spark):
    df = spark.createDataFrame([(i, "g", n) for i, n in enumerate([910, 510, 520, 920, 700])], "o int, g string, len int")
    assert sorted(r["len"] for r in groups.adaptive_filter(df, "g", "len", "o", 100, 0.10, 5).where("kept").collect()) == [910, 920]


def test_half_even(spark):
    df = spark.createDataFrame([(i, "g", n) for i, n in enumerate([47, 48, 52, 53, 50])], "o int, g string, len int")
    assert sorted(r["len"] for r in groups.adaptive_filter(df, "g", "len", "o", 100, 0.05, 5).where("kept").collect()) == [48, 50, 52]


def test_visium_layout(spark):
    b = "ACGTACGTACGTACGT"
    reads = spark.createDataFrame([(1, (b + "A" * 12)[:27]), (2, b + "A" * 12), (3, b + "C" * 12 + "GG"), (4, "T" + b[1:] + "C" * 12 + "GG"), (5, "N" + b[1:] + "C" * 12 + "GG")], "read_id int, sequence string")
    white = spark.createDataFrame([(b, 1, 2), ("C" + b[1:], 3, 4)], "spbc string, x int, y int")
    out = rows(barcodes.visium(reads, white).select("read_id", "fail_reason", "trimmed", "x"))
    assert out == [(1, "annotation", None, None), (2, "zero length", "", 1), (3, None, "GG", 1), (4, "annotation", None, None), (5, "annotation", None, None)]
    fuzzy = rows(barcodes.visium(reads, white, fraction=0.2).select("read_id", "spbc"))
    assert fuzzy[3:] == [(4, b), (5, b)]  # equally near barcodes: the smallest


def test_fuzzy_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ACGT") for _ in range(12))
    listed = [word() for _ in range(60)]
    seen = [word() for _ in range(20)] + ["".join(c if rng.random() > 0.12 else rng.choice("ACGTN") for c in rng.choice(listed)) for _ in range(80)]
    out = dict((r.observed, (r.corrected, r.distance)) for r in barcodes.closest(spark.createDataFrame([(s,) for s in seen], "o string"), spark.createDataFrame([(s,) for s in listed], "w string"), 12, 2).collect())
    want = {}
    for s in set(seen):
        d, w = min((sum(a != b for a, b in zip(s, w, strict=True)), w) for w in listed)
        if d <= 2:
            want[s] = (w, d)
    assert out == want


def test_hd_windows_are_not_broadcast(spark):
    """However small the files say they are, windows meet the index in a join that is dealt by them."""
    reads = spark.range(50).selectExpr("id AS read_id", "concat('ACGTACGTA', md5(CAST(id AS STRING))) AS sequence")
    index = spark.range(50).selectExpr("substr(md5(CAST(id AS STRING)), 1, 14) AS raw_spbc", "concat('id', id) AS spbc_id", "0 AS x", "0 AS y", "1 AS read_count")
    plan = barcodes.hd_index(reads, index, 9, (0, 1), (14,))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [raw#" in plan


@pytest.mark.parametrize("allowed", [2, 3])
def test_one_shared_piece_makes_no_candidate(spark, monkeypatch, allowed):
    """Barcodes that begin alike are no candidates by that; those within the limit are, wherever they differ."""
    monkeypatch.setattr(S, "hamming", lambda a, b: F.lit(0))
    listed = spark.createDataFrame([("ACGTAC" + "G" * 10,)], "w string")
    assert barcodes.closest(spark.createDataFrame([("ACGTAC" + "T" * 10,)], "s string"), listed, 16, allowed).count() == 0
    near = ["".join("N" if i in at else c for i, c in enumerate("ACGTAC" + "G" * 10)) for at in itertools.combinations(range(16), allowed)]
    assert barcodes.closest(spark.createDataFrame([(s,) for s in near], "s string"), listed, 16, allowed).count() == len(near)


def test_hd_index(spark):
    idx = spark.createDataFrame([("ACGTACGTACGTAC", "a", 1, 1, 5), ("CGTACGTACGTACG", "a", 1, 1, 9), ("GGGGGGGGGGGGGG", "b", None, None, None), ("GGGGGGGGGGGGGC", "c", 2, 2, 1), ("ttttttttttttta", "s_002um_01509_01169-1", None, None, None)],
                                "raw_spbc string, spbc_id string, x int, y int, read_count long")
    u = "AAAAAAAAA"
    reads = spark.createDataFrame([(1, u + "ACGTACGTACGTACG" + "TT"), (2, u + "GGGGGGGGGGGGGGC" + "TT"), (3, u + "CCCCCCCCCCCCCCCCC"), (4, u + "TTTTTTTTTTTTTA" + "CC")], "read_id int, sequence string")
    out = rows(barcodes.hd_index(reads, idx).select("read_id", "spbcid", "spbc", "x", "trimmed", "fail_reason"))
    assert out == [(1, "a", "CGTACGTACGTACG", 1, "TT", None), (2, None, None, None, None, "ambiguous"), (3, None, None, None, None, "annotation"), (4, "s_002um_01509_01169-1", "TTTTTTTTTTTTTA", 1509, "CC", None)]


def test_umi_trim(spark):
    df = spark.createDataFrame([(1, "AACCGGTT"), (2, "ACG"), (3, None)], "i int, barcode string")
    assert rows(barcodes.trim_umi(df, 4)) == [(1, "AACCGGTT", "GGTT"), (3, None, None)]


def test_headers_and_strands(spark):
    df = spark.createDataFrame([("r1|UMI=AC=G|N=1|N=2|junk",), ("r2",)], "h string")
    out = df.select(S.header_id(F.col("h")), S.header_fields(F.col("h"))).collect()
    assert [tuple(r) for r in out] == [("r1", {"UMI": "AC=G", "N": "2"}), ("r2", {})]
    seq = spark.createDataFrame([("ACGTNRY",)], "s string").select(S.reverse_complement(F.col("s")).alias("rc"))
    assert seq.first().rc == "RYNACGT"
    assert len(spark.createDataFrame([("ACG",)], "s string").select(S.neighbours(F.col("s")).alias("n")).first().n) == 9


def test_subsample_is_the_same_however_dealt(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", i) for i in range(2)], "g string, k int")
    once, again = (sorted(map(tuple, groups.subsample(d, "g", 5, "k").collect())) for d in (df, df.repartition(7)))
    assert once == again and sum(g == "a" for g, _ in once) == 5 and sum(g == "b" for g, _ in once) == 2


def test_consensus_and_alignment(spark):
    df = spark.createDataFrame([("g", "ACGTACGTAC"), ("g", "ACGTACGTAC"), ("g", "ACGTCGTAC"), ("h", "TTTT"), ("h", "TTTA"), ("h", "TTTT")], "g string, sequence string")
    aligned = consensus.align_groups(df, "g")
    assert {r.n for r in aligned.groupBy("g").agg(F.countDistinct(F.length("aligned")).alias("n")).collect()} == {1}
    out = rows(consensus.consensus(aligned, "g").select("g", "consensus", "conscount"))
    assert out == [("g", "ACGTACGTAC", 3), ("h", "TTTT", 3)]
    a, b = consensus.pairwise("ACGTACGT", "ACGACGT")
    assert len(a) == len(b) and b.replace("-", "") == "ACGACGT" and b.count("-") == 1


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("n", [400_000, 1_500_000])
def test_numbers_of_many_rows(spark, n, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = spark.range(0, n, 1, 7).select((F.col("id") * 7919 % n).alias("k"), F.concat(F.lit("ACGTACGTTTGCA"), F.col("id").cast("string")).alias("sequence"))
        out = consensus.numbered(df, "k")
        seen = out.agg(F.count("*").alias("n"), F.countDistinct("sequence").alias("d"), F.count_if(F.col("sequence_id") == F.concat(F.lit("seq"), (F.col("k") + 1).cast("string"))).alias("right")).first()
        assert tuple(seen) == (n, n, n)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_numbers_and_votes_of_odd_rows(spark):
    assert consensus.numbered(spark.createDataFrame([], "k int, m map<string,string>"), "k").count() == 0
    odd = spark.createDataFrame([(1, "a", {"x": "y"}), (None, "b", None), (1, "a", {"x": "y"})], "k int, s string, m map<string,string>")
    assert sorted((r.sequence_id, r.s) for r in consensus.numbered(odd, "k").collect()) == [("seq1", "b"), ("seq2", "a"), ("seq3", "a")]
    df = spark.createDataFrame([("g", "A", 1), ("g", "B", 1), ("g", None, 2), ("h", None, None), ("i", "A", None)], "g string, a string, b int")
    assert rows(consensus.majority(df, "g", "a", "b")) == [("g", "B", 1, 1, 2), ("i", "A", 1, None, None)]
    assert consensus.star_alignment([None, "AC", "AC"]) == ["--", "AC", "AC"]


def brute_alignment(seqs):
    """Plain centre-star alignment, cell by cell: the rows of seqs, equally long."""
    def pair(a, b):
        d = [[-2 * (i + j) for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = max(d[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), d[i - 1][j] - 2, d[i][j - 1] - 2)
        i, j, out = len(a), len(b), []
        while i or j:
            if i and j and d[i][j] == d[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1):
                i, j = i - 1, j - 1
                out.append((a[i], b[j]))
            elif i and d[i][j] == d[i - 1][j] - 2:
                i -= 1
                out.append((a[i], "-"))
            else:
                j -= 1
                out.append(("-", b[j]))
        return out[::-1]

    if len({len(s) for s in seqs}) == 1:
        return seqs
    distinct = sorted(set(seqs), key=lambda s: (len(s), s))
    centre = distinct[len(distinct) // 2]
    slots = []  # of each sequence: the inserted bases before each centre base and after the last, and its base at each
    for s in seqs:
        before, at = [""], []
        for x, y in pair(centre, s):
            if x == "-":
                before[-1] += y
            else:
                at.append(y)
                before.append("")
        slots.append((before, at))
    width = [max(len(b[i]) for b, _ in slots) for i in range(len(centre) + 1)]
    return ["".join(b[i].ljust(width[i], "-") + (at[i] if i < len(at) else "") for i in range(len(centre) + 1)) for b, at in slots]


def test_molecule_alignment_of_all_reads_against_brute_force(spark, tmp_path):
    users = [u for u in (1, 2, 3, 5, 7) for _ in range(4)] + [4] * 30
    spark.createDataFrame([(i, u) for i, u in enumerate(users)], "event_id long, user_id long").write.parquet(f"{tmp_path}/events.parquet")
    reads = queries.reads(spark, str(tmp_path)).select("read_id", "user_id", "sequence").collect()
    members = {}
    for r in reads:
        members.setdefault(r.user_id, []).append(r.sequence[: len(r.sequence) - r.read_id % 3])
    want = []
    for u, seqs in members.items():
        text, depth, same = "", 0, 0
        for column in zip(*brute_alignment(seqs), strict=True):
            bases = [c for c in column if c != "-"]
            if bases and 2 * (len(column) - len(bases)) <= len(column):
                best = min(set(bases), key=lambda c: (-bases.count(c), c))
                text, depth, same = text + best, depth + len(column), same + bases.count(best)
        want.append((u, text, len(seqs), round(1 - same / depth, 6)))
    got = rows(queries.queries()["molecule_alignment"](spark, str(tmp_path)))
    assert got == sorted(want) and len(got) == 6 and max(r[2] for r in got) == 30


def test_a_hot_group_is_split_over_tasks(spark):
    """One group of 3,000 reads beside small ones, null groups and null reads; joins split it, and the rows are the brute-force ones."""
    rng = random.Random(21)
    base = text(rng, 24)
    data = [("hot", damaged(rng, base, 0.1)) for _ in range(3000)] + [(g, damaged(rng, base, 0.1)) for g in ("a", "b", None) for _ in range(6)] + [("c", None), ("c", "ACG"), ("c", "É漢GT"), ("d", "AC"), ("d", "GT"), ("e", None)]
    df = spark.createDataFrame([(i, g, s, "q", 1) for i, (g, s) in enumerate(data)], "i int, g string, sequence string, q string, place int")
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
             "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "8k", "spark.sql.files.openCostInBytes": "1k"}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        out = consensus.align_groups(df, "g")
        assert out.columns == [*df.columns, "aligned"]
        got = {r.i: r for r in out.withColumn("task", F.spark_partition_id()).collect()}
    finally:
        for k in small:
            spark.conf.unset(k)
    assert len(got) == len(data) and all(got[i].g == g and got[i].sequence == s for i, (g, s) in enumerate(data))
    for g in ("hot", "a", "b", "c", "d", "e", None):
        own = [i for i, (x, _) in enumerate(data) if x == g]
        want = brute_alignment([data[i][1] or "" for i in own])
        assert [got[i].aligned for i in own] == want == consensus.star_alignment([data[i][1] for i in own]), g
    assert len({got[i].task for i in range(3000)}) >= 4
    assert consensus.align_groups(df.limit(0), "g").count() == 0


def test_anchor_search_against_brute_force(spark):
    def edits(p, t):  # least edits of p against any stretch of t
        row = [0] * (len(t) + 1)
        for i in range(1, len(p) + 1):
            new = [i]
            for j in range(1, len(t) + 1):
                new.append(min(row[j - 1] + (p[i - 1] != t[j - 1]), row[j] + 1, new[j - 1] + 1))
            row = new
        return min(row)

    rng = random.Random(5)
    texts = ["".join(rng.choice("ACGT") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    best, _, _ = anchors.best_ends(texts, "ACGTTGCA")
    assert [min(int(b), 8) for b in best] == [min(edits("ACGTTGCA", t), 8) for t in texts]
    reads = spark.createDataFrame([(1, "TTTACGTTGCAGGG"), (2, "CCCTGCAACGTAAA"), (3, "GGGGGGGGGGGGGG"), (4, None)], "i int, sequence string")
    found = anchors.match_anchors(reads, spark.createDataFrame([("x", "ACGTTGCA")], "anchor_id string, seq string"), 50, 0.1)
    assert rows(anchors.cut(found, barcode=True).select("i", "anchor_id", "strand", "sequence", "barcode")) == [
        (1, "x", "+", "GGG", "TTT"), (2, "x", "-", "GGG", "TTT"), (3, None, None, "GGGGGGGGGGGGGG", None), (4, None, None, None, None)]


def test_vdj(spark):
    g = spark.createDataFrame([("V1*01", "IGH", "V", "ACGTTGCAACGGTTAACCTGGATCTGT", 24), ("J1*01", "IGH", "J", "TGGGGCCAAGGAACC", 0)], "allele string, locus string, segment string, seq string, anchor int")
    core = "ACGTTGCAACGGTTAACCTGGATCTGT" + "GCAAAG" + "TGGGGCCAAGGAACC"
    reads = spark.createDataFrame([(1, core), (2, core.translate(str.maketrans("ACGT", "TGCA"))[::-1]), (3, "ACACACAC"), (4, None)], "i int, sequence string")
    out = rows(vdj.to_airr(vdj.annotate(reads, g)).select("i", "v_call", "j_call", "junction", "junction_aa", "productive"))
    assert out[0][1:] == out[1][1:] == ("V1*01", "J1*01", "TGTGCAAAGTGG", "CAKW", True)
    assert out[2][1:] == out[3][1:] == (None, None, None, None, False)


def plain_alignment(query, ref):
    """Score, begin and end in reference and query, matches and columns of the best local alignment, cell by cell."""
    n, m, no = len(ref), len(query), -(10**6)
    h, p, f, g = ([[x] * (m + 1) for _ in range(n + 1)] for x in (0, no, no, no))
    best = (0, 0, 0)
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            f[i][j] = max(h[i - 1][j] - 4, f[i - 1][j] - 1)
            g[i][j] = max(h[i][j - 1] - 4, g[i][j - 1] - 1)
            p[i][j] = h[i - 1][j - 1] + (1 if query[j - 1] == ref[i - 1] else -2)
            h[i][j] = max(0, p[i][j], f[i][j], g[i][j])
            if h[i][j] > best[0]:
                best = (h[i][j], i, j)
    (score, i, j), same, columns, mode = best, 0, 0, "h"
    while mode != "h" or h[i][j] > 0:
        if mode == "h":
            mode = "h" if h[i][j] == p[i][j] else "f" if h[i][j] == f[i][j] else "g"
            if mode == "h":
                same += query[j - 1] == ref[i - 1]
                columns, i, j = columns + 1, i - 1, j - 1
            continue
        columns += 1
        if mode == "f":
            mode, i = "h" if f[i][j] == h[i - 1][j] - 4 else "f", i - 1
        else:
            mode, j = "h" if g[i][j] == h[i][j - 1] - 4 else "g", j - 1
    return (score, i, best[1], j, best[2], same, columns) if score else (0,) * 7


def text(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def damaged(rng, seq, rate):
    out = []
    for c in seq:
        x = rng.random() / rate
        out.append(c if x > 1 else "" if x < 0.25 else c + text(rng, rng.randint(1, 4)) if x < 0.5 else rng.choice("ACGTN"))
    return "".join(out)


def test_alignment_against_cell_by_cell():
    rng = random.Random(5)
    refs = [text(rng, rng.randint(5, 90)) for _ in range(150)]
    leads = [text(rng, rng.randint(0, 12)) for _ in refs]
    queries_ = [lead + damaged(rng, r, 0.06)[rng.randint(0, 5) :] + text(rng, rng.randint(0, 12)) for lead, r in zip(leads, refs, strict=True)]
    queries_[:3] = ["", "漢字ACGT" * 5, text(rng, 40)]
    a = align.local([align.codes(q) for q in queries_], [align.codes(r) for r in refs], np.array([len(x) for x in leads]))
    for i, (q, r) in enumerate(zip(queries_, refs, strict=True)):
        want = plain_alignment(q.encode("ascii", "replace").decode(), r)
        got = tuple(int(x[i]) for x in a[:7])
        assert got[0] == want[0] and (not want[0] or got == want)
        parts = [(int(n), k) for n, k in re.findall(r"([0-9]+)([SNMDI])", align.cigar(a, i, len(q)))]
        if want[0]:
            assert sum(n for n, k in parts if k in "SMI") == len(q) and sum(n for n, k in parts if k in "NMD") == want[2]
            assert sum(n for n, k in parts if k in "MDI") == want[6]


def test_alignment_in_many_tables(monkeypatch):
    rng = random.Random(6)
    refs = [text(rng, rng.randint(5, 200)) for _ in range(60)]
    own = [align.codes(damaged(rng, r, 0.05)) for r in refs]
    args = (own, [align.codes(r) for r in refs], np.zeros(60, np.int64))
    whole = align.local(*args)
    monkeypatch.setattr(align, "CELLS", 1)
    monkeypatch.setattr(align, "PAIRS", 7)
    assert all((x == y).all() for x, y in zip(align.local(*args)[:7], whole[:7], strict=True))
    assert (align.local(*args, paths=False).score == whole.score).all()


def best_of(index, read):
    hit = index.best([[(0, align.codes(read))]])[0]
    return hit and [index.rows[g][0] for g in hit[1].alleles]


def test_every_germline_that_can_be_best_is_aligned():
    rng = random.Random(9)
    shared = text(rng, 60)
    family = [(f"V1*{i:02}", "IGH", text(rng, 20) + shared, None, None) for i in range(30)]  # a 3' read cannot tell them apart
    assert best_of(vdj.Index(family, 9, 12), shared) == [f[0] for f in family]
    base = text(rng, 70)
    near = [(f"V{i:02}", "IGH", "".join(rng.choice("ACGT") if rng.random() < rng.choice([0.02, 0.15]) else c for c in base), None, None) for i in range(25)]
    index = vdj.Index(near, 9, 12)
    for _ in range(25):
        read = text(rng, rng.randint(0, 8)) + damaged(rng, rng.choice(near)[2], 0.1)[rng.randint(0, 30) :] + text(rng, rng.randint(0, 8))
        scores = {n: plain_alignment(read, s)[0] for n, _, s, _, _ in near if any(read[i : i + 9] in s for i in range(len(read) - 8))}
        top = max(scores.values(), default=0)
        assert best_of(index, read) == (sorted(n for n, s in scores.items() if s == top) if top >= 12 else None)


def test_blocks_of_reads_are_seeded_together(monkeypatch):
    """Alleles that lie whole in a read need no table, however many reads; parts and blocks of any size give the same fields."""
    rng = random.Random(12)
    own = [(f"V{i}*01", "IGH", "V", text(rng, 60), 57, None) for i in range(6)] + [("J1*01", "IGH", "J", text(rng, 30), 0, None), ("D1*01", "IGH", "D", text(rng, 14), None, None)]
    index = vdj.index_of(own)
    whole = [own[i % 6][3] + text(rng, i % 5) + own[7][3] + text(rng, i % 4) + own[6][3] for i in range(200)]
    with monkeypatch.context() as m:
        m.setattr(align, "_table", None)
        out = vdj.call(whole, index)
    assert out["v_call"] == [own[i % 6][0] for i in range(200)] and set(out["v_cigar"]) == {f"60M{len(s) - 60}S" for s in whole} and set(out["j_call"]) == {"J1*01"}
    reads = ["", text(rng, 5)] + [damaged(rng, s, 0.05) for s in whole] + [damaged(rng, s, 0.02)[::-1].translate(str.maketrans("ACGT", "TGCA")) for s in whole]
    want = vdj.call(reads, index)
    monkeypatch.setattr(vdj, "SHARED", 50)
    assert vdj.call(reads, index) == want
    monkeypatch.setattr(vdj, "BASES", 500)
    parts = [vdj.call(reads[a:b], index) for a, b in vdj.blocks(reads, index)]
    assert len(parts) > 9 and {k: [x for p in parts for x in p[k]] for k in want} == want


def plain_pair(a, b):
    """Cell by cell; on the way back a pair of bases comes before a base of the first and that before a base of the second."""
    score = [[-2 * (i + j) for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        score[i][j] = max(score[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), score[i - 1][j] - 2, score[i][j - 1] - 2)
    i, j, p, q = len(a), len(b), "", ""
    while i or j:
        if i and j and score[i][j] == score[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1):
            i, j, p, q = i - 1, j - 1, a[i - 1] + p, b[j - 1] + q
        elif i and score[i][j] == score[i - 1][j] - 2:
            i, p, q = i - 1, a[i - 1] + p, "-" + q
        else:
            j, p, q = j - 1, "-" + p, b[j - 1] + q
    return p, q


def test_pairs_are_aligned_together(monkeypatch):
    """Many pairs of any lengths share tables, and each is aligned as alone."""
    rng = random.Random(14)
    a = ["", "", "ACGT", "漢字A"] + [text(rng, rng.randint(0, 50)) for _ in range(150)]
    b = ["", "AC", "", "漢A"] + [damaged(rng, s, 0.1) + text(rng, rng.randint(0, 5)) for s in a[4:]]
    want = [plain_pair(x, y) for x, y in zip(a, b, strict=True)]
    tables, own = [], consensus._table
    monkeypatch.setattr(consensus, "_table", lambda pairs, *rest: tables.append(len(pairs)) or own(pairs, *rest))
    assert consensus.pairwise_all(a, b) == want and len(tables) == 1
    for cells in (20_000, 1):
        monkeypatch.setattr(consensus, "CELLS", cells)
        assert consensus.pairwise_all(a, b) == want
    assert tables[-1] == 1 < max(tables[1:-1])


def test_junction_moves_with_indels(spark):
    rng = random.Random(10)
    v, d, j, c = text(rng, 281) + "TGTGCGAGA", text(rng, 20), "TGGGGCCAAGGGACC" + text(rng, 20), text(rng, 60)
    g = spark.createDataFrame([("V1*01", "IGH", "V", v, 281), ("D1*01", "IGH", "D", d, None), ("J1*01", "IGH", "J", j, 0), ("C1*01", "IGH", "C", c, None), ("C2*01", "IGH", "C", text(rng, 60), None)],
                              "allele string, locus string, segment string, seq string, anchor int")
    tail = "GC" + d + "A" + j + c
    reads = {"whole": v, "deleted at 200": v[:200] + v[203:], "deleted at 120": v[:120] + v[123:], "inserted": v[:100] + "ACGTA" + v[100:], "late begin": v[150:], "codon gone": v[:280] + v[284:]}
    out = {r.i: r for r in vdj.to_airr(vdj.annotate(spark.createDataFrame([(k, x + tail) for k, x in reads.items()] + [("J lost", v + "GC" + d)], "i string, sequence string"), g)).collect()}
    for k, x in reads.items():
        r = out[k]
        assert (r.v_call, r.d_call, r.j_call, r.c_call, r.locus, r.v_sequence_start, r.rev_comp) == ("V1*01", "D1*01", "J1*01", "C1*01", "IGH", 1, False), k
        if k == "codon gone":
            assert r.junction is None or len(r.junction) % 3 or r.junction.startswith("TGT")
            continue
        assert r.v_sequence_end == len(x) and r.junction == "TGTGCGAGAGC" + d + "ATGG" and (r.np1, r.np2, r.np1_length, r.np2_length) == ("GC", "A", 2, 1), k
    assert out["late begin"].v_germline_start == 151 and out["deleted at 200"].v_identity == pytest.approx(287 / 290)
    assert out["J lost"].junction is None and out["J lost"].j_call is None and not out["J lost"].productive


def test_regions_by_hand(spark):
    """A V with one missing column in CDR1 and ten in CDR2; the read lacks a base of FWR3 and has one too many in FWR2."""
    rng = random.Random(11)
    bases = text(rng, 81) + "C" + text(rng, 225 - 3) + "TGT" + "GCGAGA"
    gapped = list("x" * 318)
    for at in [90, *range(170, 180)]:
        gapped[at] = "."
    it = iter(bases)
    gapped = "".join(c if c == "." else next(it, "") for c in gapped)
    assert gapped.replace(".", "") == bases[: 318 - 11]
    v = gapped.replace(".", "")
    anchor = len(v) - 9
    v = v[:anchor] + "TGTGCGAGA"
    gapped = gapped[:309] + "TGTGCGAGA"
    j = "TGGGGCCAAGGGACCACGGTCACC"
    at = {n: (len(gapped[: a - 1].replace(".", "")), len(gapped[:b].replace(".", ""))) for n, (a, b) in vdj.REGIONS.items()}
    insert, delete = at["fwr2"][0] + 20, at["fwr3"][0] + 30
    while v[insert - 1 : insert + 1].count("G") or v[insert - 1] == v[insert]:
        insert += 1
    while v[delete] in (v[delete - 1], v[delete + 1]):
        delete += 1
    read = v[:insert] + "G" + v[insert:delete] + v[delete + 1 :] + "AA" + j
    g = spark.createDataFrame([("V1*01", "IGH", "V", v, anchor, gapped), ("J1*01", "IGH", "J", j, 0, None)], "allele string, locus string, segment string, seq string, anchor int, gapped string")
    r = vdj.to_airr(vdj.annotate(spark.createDataFrame([(read,), (v[100:] + "AA" + j,)], "sequence string"), g)).orderBy(F.length("sequence").desc()).collect()
    whole, late = r
    for n, (a, b) in at.items():
        want = v[a:b] if n != "fwr3" else v[a:delete] + v[delete + 1 : b]
        assert whole[n] == want, n
    column = [i for i, c in enumerate(gapped) if c != "."][delete]
    row = gapped[:column] + "-" + gapped[column + 1 :]
    assert whole.sequence_alignment == row + "AA" + j and whole.germline_alignment == gapped + "NN" + j
    assert (whole.cdr3, whole.fwr4, whole.junction, whole.np1, whole.np2) == ("GCGAGAAA", j, "TGTGCGAGAAATGG", "AA", None)
    assert whole.v_cigar == f"{insert}M1I{delete - insert}M1D{len(v) - delete - 1}M{2 + len(j)}S"
    assert late.fwr1 == "" and late.sequence_alignment.startswith("." * 101) and late.v_germline_start == 101 and late.fwr3 == v[slice(*at["fwr3"])]


def test_vdj_of_odd_reads(spark):
    g = spark.createDataFrame([("V1*01", "IGH", "V", "ACGTTGCAACGGTTAACCTGGATCTGT", 24)], "allele string, locus string, segment string, seq string, anchor int")
    odd = [(None, 1), ("", 1), ("漢字" * 50, 2), ("n" * 300, 2), ("acgttgcaacggttaacctggatctgt", 3), ("ACGTTGCAACGGTTAACCTGGATCTGT", 3), ("ACGTTGCAACGGTTAACCTGGATCTGT", 3), ("ACGTTGCAACGGTT" * 4000, 4)]
    df = spark.createDataFrame([(*x, "kept") for x in odd], "sequence string, i int, v_row_ string")
    out = vdj.to_airr(vdj.annotate(df, g)).collect()
    assert [r.v_call for r in out] == [None] * 4 + ["V1*01"] * 4 and all(r.v_row_ == "kept" and r.j_call is None for r in out)
    none = vdj.annotate(df.limit(0), g)
    assert none.count() == 0 and vdj.to_airr(vdj.annotate(df, g.limit(0))).where("v_call is null").count() == len(odd)


@pytest.mark.parametrize("allowed", [4, 5, 7])
def test_barcodes_with_many_mismatches(spark, allowed):
    rng = random.Random(allowed)
    listed = [text(rng, 16) for _ in range(60)] + ["A" * 16]
    seen = ["".join(rng.choice("ACGTN") if rng.random() < 0.3 else c for c in rng.choice(listed)) for _ in range(150)] + ["A" * 15, "C" * 16, "AAAACCCCGGGGTTTT"]
    got = rows(barcodes.closest(spark.createDataFrame([(s,) for s in seen], "s string"), spark.createDataFrame([(s,) for s in listed], "w string"), 16, allowed))
    want = []
    for s in sorted({s for s in seen if len(s) == 16}):
        d, w = min((sum(x != y for x, y in zip(s, w, strict=True)), w) for w in listed)
        if d <= allowed:
            want.append((s, w, d))
    assert got == want
    with pytest.raises(ValueError):
        barcodes.closest(spark.createDataFrame([("AC",)], "s string"), spark.createDataFrame([("AC",)], "w string"), 2, 2)


def test_clones_of_junctions_that_begin_and_end_alike(spark):
    """Single linkage against brute force, and how many pairs the join compares."""
    rng = random.Random(3)
    seeds = ["TGTGCG" + text(rng, 33) + "TGG" for _ in range(250)]
    own = sorted({s for x in seeds for s in [x, *("".join(rng.choice("ACGT") if 6 <= i < 39 and rng.random() < 0.06 else c for i, c in enumerate(x)) for _ in range(2))]})
    out = {r.junction: r.clone_id for r in clones.assign(spark.createDataFrame([("IGHV1*01", "IGHJ1*01", s) for s in own], "v_call string, j_call string, junction string")).collect()}
    lead = {s: s for s in own}

    def find(s):
        while lead[s] != s:
            s = lead[s]
        return s

    near = [(a, b) for a, b in itertools.combinations(own, 2) if sum(x != y for x, y in zip(a, b, strict=True)) <= 4]
    for a, b in near:
        lead[find(a)] = find(b)
    groups_ = {}
    for s in own:
        groups_.setdefault(find(s), set()).add(out[s])
    assert all(len(g) == 1 for g in groups_.values()) and len({next(iter(g)) for g in groups_.values()}) == len(groups_)
    dealt = lambda s: ["".join(s[i::6]) for i in range(6)]
    keys = {}
    for s in own:
        for i, j in itertools.combinations(range(6), 2):
            keys.setdefault((i, j, dealt(s)[i], dealt(s)[j]), []).append(s)
    compared = {p for g in keys.values() for p in itertools.combinations(sorted(g), 2)}
    assert set(map(tuple, map(sorted, near))) <= compared and len(compared) < 2 * len(near) < len(own) ** 2 / 100


def test_a_collapse_searches_each_read_once_and_writes_its_record(spark, tmp_path):
    rng = random.Random(17)
    seen = spark.sparkContext.accumulator(0)
    anchor, tags = "ACGTTGCAACGGTTAACC", [text(rng, 12) for _ in range(5)]
    body = [text(rng, 50) for _ in tags]  # at the middle of its length class
    reads = [(f"r{i}", ("CC" + tags[i % 5] + anchor + body[i % 5]) if i % 6 else text(rng, 70), i) for i in range(60)]

    def counted(s):
        seen.add(1)
        return s

    own = spark.createDataFrame(reads, "read_id string, sequence string, read_ord long").withColumn("sequence", F.udf(counted, "string")("sequence"))
    root = str(tmp_path / "run")
    metadata.start_run(root, "1")
    p = pipelines.CollapseParams(library="bulk", window=40, error=0.1, umi_length=12, min_group=3)
    counts = pipelines.collapse_run(own, spark.createDataFrame([("U", anchor)], "anchor_id string, seq string"), p, root, str(tmp_path / "out"), sample="s1")
    assert seen.value == 60
    assert counts == {"input_reads": 60, "annotated_reads": 50, "length_filtered_reads": 50, "retained_group_reads": 50, "consensus_sequences": 5}
    made = spark.read.parquet(f"{tmp_path}/out/consensus").collect()
    assert {(r.umi, r.sequence, r.conscount) for r in made} == {(t, b, 10) for t, b in zip(tags, body, strict=True)}
    assert {r.fail_reason for r in spark.read.parquet(f"{tmp_path}/out/failed").collect()} == {"anchor"}
    rec = metadata.read_records(spark, root).first()
    assert rec.counts == counts and rec.sample == "s1" and rec.parameters["adaptive_filter"] == "true" and metadata.report(spark, root, strict=True) == []


def test_read_report_sums_shown_qualities(spark):
    """Qualities count to six places: their thousandths are rounded from those, half to even."""
    own = {"4cc05b35c2f937c5bd9e7d41d3686fff": 21610, "7da9fd85999f583e3906f99a3ee58911": 21616, "21be992eb8016e541a15953eee90760e": 19778}  # 21.6094995, 21.6165001, 19.7774997
    df = spark.createDataFrame([("A" * (i + 1), q) for i, q in enumerate(own)], "sequence string, quality string")
    assert [r.quality_milli for r in filters.read_report(df).orderBy("length_class").collect()] == list(own.values())
    assert filters.quality_length(df, min_quality=21.6095).count() == 2  # the first is shown as the limit


def test_read_report_against_exact_numbers(spark):
    rng = random.Random(31)
    data = [(text(rng, int(rng.lognormvariate(6, 1)) + 1), rng.randint(34, 70)) for _ in range(800)] + [("", 40), ("ACGT" * 20_000, 60)]
    df = spark.createDataFrame([(s, chr(q) * len(s) if s else None, "x") for s, q in data] + [(None, None, "x")], "sequence string, quality string, n string")
    report = filters.read_report(df, 10, 100, 2000)
    seen = report.collect()
    assert sum(r.n_reads for r in seen) == len(data) and {r.quality_class for r in seen if r.n_bases == 0} == {None}
    halves = filters.read_report(df.limit(300), 10, 100, 2000).unionByName(filters.read_report(df.offset(300), 10, 100, 2000))
    out = {r.stage: r for r in filters.report_statistics(report).collect()}
    assert out == {r.stage: r for r in filters.report_statistics(halves).collect()}  # reports add up
    for stage, kept in (("before", data), ("after", [(s, q) for s, q in data if 100 <= len(s) <= 2000 and q - 33 >= 10])):
        n = sorted(len(s) for s, _ in kept)
        far, half = 0, sum(n) / 2
        for x in reversed(n):
            far += x
            if far >= half:
                break
        r = out[stage]
        assert (r.n_reads, r.n_bases) == (len(n), sum(n)) and r.mean_length == pytest.approx(sum(n) / len(n))
        assert r.n50 <= x < r.n50 * (1 + 1 / 64) + 1 and r.median_length <= n[(len(n) - 1) // 2] < r.median_length * (1 + 1 / 64) + 1
        assert r.mean_quality == pytest.approx(sum(q - 33 for s, q in kept if s) / sum(1 for s, _ in kept if s), abs=1e-3)
    assert filters.report_statistics(filters.read_report(df.limit(0))).count() == 0


def test_reads_of_one_quality_pass_that_limit(spark):
    df = spark.createDataFrame([("ACGT" * n, chr(33 + q) * 4 * n) for q in range(1, 42) for n in (1, 25, 256, 427)], "sequence string, quality string")
    for q in (10, 20, 30, 40):
        assert filters.quality_length(df, q).count() == 4 * (42 - q)


def test_strict_reading_of_records(spark, tmp_path):
    root = tmp_path / "run"
    metadata.start_run(str(root), "1.0")
    t = ("2024-01-01T10:00:00+00:00", "2024-01-01T10:01:00+00:00")
    metadata.write_record(str(root), "filter", "run", {"input_reads": 5, "filtered_reads": 4}, *t, files={"log": "x"})
    folder = root / metadata.FOLDER / "metadata"
    good = json.loads((folder / "filter" / "run.json").read_text())
    assert metadata.problems(spark, str(root)).count() == 0
    cases = {
        "schema_version is no whole number": {"schema_version": "1"}, "schema_version is another one": {"schema_version": 2}, "run_id is no text": {"run_id": 5}, "run_id is that of another run": {"run_id": "x"},
        "module is not its folder": {"module": "demux"}, "status is no text": {"status": " "}, "unknown status": {"status": "odd"}, "unknown scope": {"scope_type": "cell"},
        "scope without a sample": {"scope_type": "sample"}, "scope without a locus": {"scope_type": "locus", "locus": ""}, "started_at is no ISO date": {"started_at": "yesterday"},
        "finished before start": {"finished_at": "2023-01-01T00:00:00+00:00"}, "counts is no object": {"counts": [1]}, "parameters is no object": {"parameters": None}, "files is no object": {"files": "f"},
        "count 'a' is no whole number of 0 or more": {"counts": {"a": -1, "b": 2}}, "count 'b' is no whole number of 0 or more": {"counts": {"a": 1, "b": True}},
        "count 'c' is no whole number of 0 or more": {"counts": {"c": 1.5}}, "count 'd' is no whole number of 0 or more": {"counts": {"d": "7"}}, "file 'f' is no path": {"files": {"f": ""}}, "file 'g' is no path": {"files": {"g": 3}},
        "duration_seconds is no number of 0 or more": {"duration_seconds": -1}, "finished_at is no text": {"finished_at": None}}
    for i, change in enumerate(cases.values()):
        (folder / "filter" / f"c{i}.json").write_text(json.dumps({**good, "record_id": f"c{i}", **change}))
    (folder / "filter" / "text.json").write_text("{no json")
    (folder / "filter" / "list.json").write_text("[1]")
    (folder / "loose.json").write_text(json.dumps({**good, "record_id": "loose"}))
    (folder / "filter" / "other.json").write_text(json.dumps({**good, "record_id": "named"}))
    (folder / "filter" / "deeper").mkdir()
    (folder / "filter" / "deeper" / "run.json").write_text(json.dumps(good))
    (folder / "filter" / "more.json").write_text(json.dumps({**good, "record_id": "more", "version": "2", "extra": 1}))
    got = {}
    for r in metadata.problems(spark, str(root)).collect():
        got.setdefault(r.path.split("/metadata/")[1], set()).add((r.severity, r.problem))
    for i, (problem, change) in enumerate(cases.items()):
        assert got.pop(f"filter/c{i}.json") == {("error", problem)}, change
    assert got.pop("loose.json") >= {("error", "not below a module's folder")}
    doubles = [got.pop(k) for k in ("filter/run.json", "filter/deeper/run.json") if k in got]
    assert doubles == [{("error", "duplicate record")}]
    assert got == {
        "filter/text.json": {("error", "no JSON")}, "filter/list.json": {("error", "not an object")}, "filter/other.json": {("error", "record_id is not its file's name")},
        "filter/more.json": {("warning", "unknown field extra"), ("warning", "version is not the run's")}}
    with pytest.raises(ValueError, match="no JSON"):
        metadata.report(spark, str(root))
    (root / metadata.FOLDER / "run.json").write_text('{"schema_version": true}')
    with pytest.raises(ValueError, match="schema_version"):
        metadata.problems(spark, str(root))


def test_malformed_fastq_is_counted(spark, tmp_path):
    good = [f"@r{i} d\n{'ACGT' * (i % 5 + 1)}\n+\n{'IIII' * (i % 5 + 1)}\n" for i in range(60)]
    broken = [*good[:20], "@short\nACGT\n+\nII\n", *good[20:40], "lost line\n\n", *good[40:], "@cut\nAC\n"]
    (tmp_path / "a.fastq").write_text("".join(broken))
    for split in (1 << 20, 150):
        kept = sequences.read_fastq(spark, str(tmp_path), malformed="keep", splitBytes=split).collect()
        assert [r.read_id for r in kept if r.read_id] == [f"r{i}" for i in range(60)] == [r.read_id for r in sequences.read_fastq(spark, str(tmp_path), splitBytes=split).collect()]
        odd = [r.description for r in kept if r.read_id is None]
        assert split == 150 or odd == ["4 lines: @short", "1 lines: lost line", "2 lines: @cut"]
    with pytest.raises(Exception, match="belong to no record"):
        sequences.read_fastq(spark, str(tmp_path), malformed="fail").collect()


def test_a_stream_of_fastq_files_goes_on_where_it_stopped(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()

    def arrive(name, ids):
        whole = tmp_path / name
        whole.write_text("".join(f"@r{i}\nACGT\n+\nIIII\n" for i in ids))
        whole.rename(folder / name)

    def run():
        stream = sequences.stream_fastq(spark, str(folder), splitBytes=100)
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(once=True).start()
        q.awaitTermination(120)
        assert q.exception() is None
        return sorted(int(r.read_id[1:]) for r in spark.read.parquet(out).collect())

    arrive("b.fastq", range(0, 40))
    assert run() == list(range(40))
    assert run() == list(range(40))
    arrive("a.fastq", range(40, 70))  # sorts before the one that has been read
    arrive("c.fq", range(70, 75))
    assert run() == list(range(75))
    assert spark.read.parquet(out).select("read_ord").distinct().count() == 75


def test_small_sources_and_orders(spark, tmp_path):
    (tmp_path / "list.txt").write_text("ACGT first\n\n  GGTT\nAAAA 2\n")
    assert rows(sequences.read_sequence_list(spark, str(tmp_path / "list.txt")), "ord") == [("ACGT", 0), ("GGTT", 1), ("AAAA", 2)]
    (tmp_path / "anchors.fasta").write_text(">Ig | 1 | IGHA \nacgt\nAA\n>TCR | 2 | TRBC\nGG\n")
    assert [tuple(r) for r in sequences.read_anchors(spark, str(tmp_path / "anchors.fasta")).collect()] == [("Ig | 1 | IGHA", "ACGTAA"), ("TCR | 2 | TRBC", "GG")]
    (tmp_path / "scale.json").write_text('{\n"tissue_hires_scalef": 0.25,\n"tissue_lowres_scalef": 0.1}')
    assert sequences.read_scale(spark, str(tmp_path / "scale.json")) == 0.25
    spark.createDataFrame([("s_1", "b_1", "cell_1", True, 9)], "square_002um string, square_016um string, cell_id string, in_cell boolean, extra int").write.parquet(f"{tmp_path}/map")
    spark.createDataFrame([(1.5, "s_1", 2.5, 0)], "pxl_row_in_fullres double, barcode string, pxl_col_in_fullres double, in_tissue int").write.parquet(f"{tmp_path}/pos")
    assert rows(sequences.read_spatial_mapping(spark, f"{tmp_path}/map")) == [("s_1", "b_1", "cell_1", True)]
    assert rows(sequences.read_positions(spark, f"{tmp_path}/pos")) == [("s_1", 1.5, 2.5)]
    assert rows(filters.tagged(spark.createDataFrame([("a", 0), ("b", 1), ("c", None)], "r string, dx int"), 1)) == [("b", 1)]
    root = tmp_path / "run"
    metadata.start_run(str(root), "1")
    (root / "deep" / "er").mkdir(parents=True)
    assert metadata.find_root(str(root / "deep" / "er")) == root.resolve() and metadata.find_root(str(tmp_path)) is None
    assert spark.createDataFrame([("min_group_size",), (None,)], "k string").select(S.humanise(F.col("k"))).collect() == [("Min Group Size",), (None,)]
    own = [("airr", "b", "tr", "b_tr"), ("airr", "b", "ig", "b_ig"), ("airr", "a", "tr", "a_tr"), ("filter", None, None, "run"), ("polish", None, None, "x"), ("demux", "a", None, "a"), ("demux", None, None, "run")]
    df = spark.createDataFrame([(*r, {"log": f"/{r[3]}.log", "nanoplot_report": "/q.HTML", "page": "/p.html"}) for r in own], "module string, sample string, locus string, record_id string, files map<string,string>").withColumn("run_id", F.lit("r"))
    assert [(r.module, r.record_id) for r in runmeta.ordered(df).collect()] == [("filter", "run"), ("demux", "run"), ("demux", "a"), ("airr", "a_tr"), ("airr", "b_ig"), ("airr", "b_tr"), ("polish", "x")]
    assert {(r.module, r.key) for r in runmeta.quality_links(df).collect()} == {(m, k) for m in ("airr", "filter", "polish", "demux") for k in ("nanoplot_report", "page")}


def test_reads_beyond_ascii(spark):
    reads = spark.createDataFrame([(1, "漢字漢字ACGTTGCAGGG"), (2, "é" * 30), (3, "")], "i int, sequence string")
    found = anchors.match_anchors(reads, spark.createDataFrame([("x", "ACGTTGCA")], "anchor_id string, seq string"), 50, 0.1)
    assert rows(found.select("i", "anchor_id", "start", "end")) == [(1, "x", 4, 12), (2, None, None, None), (3, None, None, None)]
    a, b = consensus.pairwise("ACé漢T", "AC漢T")
    assert (a, b) == ("ACé漢T", "AC-漢T")


def test_clones_of_golden_rows(spark):
    data = [
        ("a", "IGHV3-23*01,IGHV3-23D*01", "IGHJ4*01", "TGTGCGAAAGTTTACTACGGTGGTAAGGAAATTGACTACTGG"), ("b", "IGHV3-23*01,IGHV3-23D*01", "IGHJ4*01", "TGTGCGAAAGTTTACTACGGTGGTAAGGAAATTGACTACTGG"),
        ("c", "IGHV3-30*04,IGHV3-30-3*03", "IGHJ4*01", "TGTGCGAGAGGCCGTGGCTACTGCCTTGACTACTGG"), ("d", "IGHV3-30*04,IGHV3-30-3*03", "IGHJ4*01", "TGTGCGAGAGGCCGTGGGAGCTACTGCCTTGACTACTGG"),
        ("e", "IGHV3-30*04,IGHV3-30*19,IGHV3-30-3*03", "IGHJ4*01", "TGTGCGAGAGGCCGTGGGAGCTACTGCCTTGACTACTGG"), ("f", None, "IGHJ4*01", "TGT")]
    out = {r.id: r.clone_id for r in clones.assign(spark.createDataFrame(data, "id string, v_call string, j_call string, junction string")).collect()}
    assert out["a"] == out["b"] and out["d"] == out["e"] and len({out["a"], out["c"], out["d"]}) == 3 and out["f"] is None


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (7, 7), (20, 21), (21, 22), (22, 20)]
    out = rows(components.components(spark.createDataFrame(edges, "a int, b int"), "a", "b"))
    assert out == [(1, 1), (2, 1), (3, 1), (4, 1), (10, 10), (11, 10), (20, 20), (21, 20), (22, 20)]


def test_sources(spark, tmp_path):
    fq = tmp_path / "r.fastq"
    rng = random.Random(1)
    want = []
    with fq.open("w") as f:
        for i in range(300):
            s = "".join(rng.choice("ACGT") for _ in range(rng.randint(1, 60)))
            q = "".join(rng.choice("@+I#") for _ in s)
            want.append((f"r{i}", s, q))
            f.write(f"@r{i} some text\n{s}\n+\n{q}\n")
    for split in (97, 4096, 1 << 20):
        got = sequences.read_fastq(spark, str(fq), splitBytes=split).orderBy("read_ord").collect()
        assert [(r.read_id, r.sequence, r.quality) for r in got] == want
    fa = tmp_path / "a.fasta"
    fa.write_text(">x|UMI=AC|N=3\nACGT\nTT\n>y\nGG\n")
    got = sequences.read_fasta(spark, str(fa), splitBytes=7).orderBy("read_ord").collect()
    assert [(r.read_id, r.annotations, r.sequence) for r in got] == [("x", {"UMI": "AC", "N": "3"}, "ACGTTT"), ("y", {}, "GG")]
    wl = tmp_path / "w.txt"
    wl.write_text("ACGT\nAAAA 1 2\nCCCC 3 4 5\n")
    assert rows(sequences.read_whitelist(spark, str(wl))) == [("AAAA", 1, 2), ("ACGT", None, None), ("CCCC", 3, 4)]
    db = tmp_path / "i.sqlite"
    with sqlite3.connect(db) as c:
        c.execute("CREATE TABLE spbc_lookup (raw_spbc TEXT, spbc_id TEXT, x INT, y INT, raw_spbc_len INT, read_count INT)")
        c.executemany("INSERT INTO spbc_lookup VALUES (?,?,?,?,?,?)", [("acgt", "i1", 1, 2, 4, None), ("ACGTA", "i2", 1, 3, 5, 7)])
    assert rows(sequences.read_barcode_index(spark, str(db))) == [("ACGT", "i1", 1, 2, 4, 0), ("ACGTA", "i2", 1, 3, 5, 7)]
    assert rows(sequences.read_barcode_index(spark, str(db), [5])) == [("ACGTA", "i2", 1, 3, 5, 7)]
    table = spark.createDataFrame([("s1", True, None, 4)], "sequence_id string, productive boolean, v_call string, consensus_count long")
    sequences.write_airr(table, str(tmp_path / "airr"))
    assert rows(sequences.read_airr(spark, str(tmp_path / "airr"))) == [("s1", True, None, 4)]
    sequences.write_fasta(spark.createDataFrame([("h1", "AC", "k1"), ("h2", "GT", "k2")], "header string, sequence string, udi string"), str(tmp_path / "out"), by="udi")
    assert {p.parent.name: p.read_text() for p in (tmp_path / "out").rglob("part-*")} == {"udi=k1": ">h1\nAC\n", "udi=k2": ">h2\nGT\n"}


def test_collapse_end_to_end(spark):
    b, r1 = "ACGTACGTACGTACGT", "CTACACGACGCTCTTCCGATCT"
    rng = random.Random(9)
    body = ["".join(rng.choice("ACGT") for _ in range(80)) for _ in range(2)]
    turn = lambda s: s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    data = [("r1", r1 + b + "A" * 12 + body[0], 1), ("r2", turn("TT" + r1 + b + "A" * 12 + body[0]), 2), ("r3", r1 + b + "AAAAAAGGGGGG" + body[1], 3), ("r4", "ACGT" * 30, 4)]
    reads = spark.createDataFrame(data, "read_id string, sequence string, read_ord long")
    anchor = spark.createDataFrame([("R1", r1)], "anchor_id string, seq string")
    white = spark.createDataFrame([(b, 5, 6)], "spbc string, x int, y int")
    p = pipelines.CollapseParams(library="visium", window=60)
    out = rows(pipelines.collapse(reads, anchor, p, white).select("sequence_id", "group", "sequence", "conscount", "n_orig", "x"))
    assert out == [("seq1", b + "A" * 12, body[0], 2, 2, 5), ("seq2", b + "AAAAAAGGGGGG", body[1], 1, 1, 5)]
    bulk = pipelines.CollapseParams(library="bulk", window=60, umi_length=4)
    own = spark.createDataFrame([("r1", "AACCGGTT" + r1 + body[0], 1), ("r2", "AACC" + r1 + body[1], 2)], "read_id string, sequence string, read_ord long")
    assert [r[0] for r in rows(pipelines.collapse(own, anchor, bulk).select("group"))] == ["AACC", "GGTT"]
    assert filters.counters(pipelines.annotate(reads, anchor, p, white)).first().asDict() == {"total": 4, "passed": 3, "failed": 1}


def test_run_records_and_report(spark, tmp_path):
    root = str(tmp_path)
    metadata.start_run(root, "1")
    t = ("2024-01-01T10:00:00+00:00", "2024-01-01T10:01:30+00:00")
    metadata.write_record(root, "filter", "run", {"input_reads": 100, "filtered_reads": 90}, *t, parameters={"min_quality": 10})
    metadata.write_record(root, "demux", "run", {"input_reads": 90, "matched_reads": 80, "unmatched_reads": 10, "sample_count": 2}, *t)
    for s, n in (("a", 50), ("b", 30)):
        metadata.write_record(root, "demux", s, {"assigned_reads": n}, *t, sample=s)
        metadata.write_record(root, "collapse", s, {"input_reads": n, "annotated_reads": n - 5, "length_filtered_reads": n - 6, "retained_group_reads": n - 7, "consensus_sequences": 9}, *t, sample=s, parameters={"library": "bulk"})
        metadata.write_record(root, "seqtag", s, {"input_sequences": 9, "matched_sequences": 8, "failed_sequences": 1, "split_ig_sequences": 8}, *t, sample=s)
        metadata.write_record(root, "airr", f"{s}_ig", {"input_sequences": 8, "airr_sequences": 7, "productive_sequences": 6}, *t, sample=s, locus="ig")
    assert metadata.report(spark, root, strict=True) == []
    lines = (tmp_path / "summary.tsv").read_text().splitlines()
    assert lines[2].startswith("Step\tPathInfo") and "Filtering\trun\t2024-01-01 10:01:30\t100\t90\t90.0%\tUnfiltered reads\tFiltered reads (minimum quality: 10)" in lines
    assert (tmp_path / "report.html").read_text().count("<table>") == 10
    page = open(f"{root}/report.html").read()
    assert all(f"<h2>{t}</h2>" in page for t in ("Warnings", "Module summary", "Consensus and receptor yield", "Locus results", "Parameters", "Files")) and page.count("class=panel") == 3
    assert "--min-qual" in page and "UMI annotated" in page and page.count("class=bar") >= 8
    rec = metadata.read_records(spark, root)
    assert runmeta.overview(rec).first().consensus_sequences == 18
    assert [(r.label, r.value) for r in runmeta.retention(runmeta.read_stages(rec)).orderBy("stage_no").collect()] == [
        ("Input reads", 100), ("Filtered reads", 90), ("Demultiplexed reads", 80), ("UMI annotated", 70), ("Fixed-length filtered", 68), ("AF-retained group reads", 66)]
    assert {(r.locus, r.sample): r.input for r in runmeta.loci(rec).collect()} == {("ig", None): 16, ("ig", "a"): 8, ("ig", "b"): 8}
    metadata.write_record(root, "collapse", "c", {"input_reads": 5, "annotated_reads": 7}, *t, sample="c")
    metadata.write_record(root, "demux", "run", {"input_reads": 91, "matched_reads": 80, "unmatched_reads": 10, "sample_count": 3}, *t)
    assert len(metadata.report(spark, root, validate_only=True)) == 5  # rise, sum, handover, unexpected sample, sample number
    with pytest.raises(ValueError, match="unmatched|collapse"):
        metadata.report(spark, root, strict=True)
    bad = tmp_path / metadata.FOLDER / "metadata" / "airr" / "x.json"
    bad.write_text(json.dumps({"run_id": "other", "module": "seqtag", "record_id": "y", "scope_type": "run", "status": "success", "counts": {"n": -1}}))
    with pytest.raises(ValueError, match="other run"):
        metadata.report(spark, root)


def test_neighbours_at_a_distance(spark):
    seq = "ACGT"
    for k in range(5):
        want = sorted("".join(x) for x in itertools.product("ACGT", repeat=4) if sum(a != b for a, b in zip(x, seq)) == k)
        got = spark.createDataFrame([(seq,)], "s string").select(S.neighbours(F.col("s"), distance=k).alias("n")).first().n
        assert sorted(got) == want
    odd = spark.createDataFrame([("",), (None,)], "s string").select(S.neighbours(F.col("s"), distance=2).alias("n")).collect()
    assert [r.n for r in odd] == [[], None]


def test_scalar(spark):
    texts = ["12", "1.5", "true", "null", "plain text", '"quoted"', "[1, 2]", "", 'a "b" }c\\', None]
    got = [json.loads(r.v) if r.v is not None else None for r in spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string").orderBy("i").select(F.to_json(S.scalar(F.col("t"))).alias("v")).collect()]
    assert got == [12, 1.5, True, None, "plain text", "quoted", [1, 2], "", 'a "b" }c\\', None]


def test_headers_by_library(spark):
    own = spark.createDataFrame([("seq1", "g", 3, "AC", "P", "S", 1, "b2"), ("seq2", "h", 1, None, None, "S", None, None)], "sequence_id string, group string, conscount int, umi string, primer string, spbc string, x int, bc2 string")
    got = {lib: [r.header for r in consensus.with_header(own, lib).orderBy("sequence_id").collect()] for lib in ("bulk", "visium", "visiumhd")}
    assert got["bulk"] == ["seq1|GROUP=g|CONSCOUNT=3|UMI=AC", "seq2|GROUP=h|CONSCOUNT=1"]
    assert got["visium"] == ["seq1|GROUP=g|CONSCOUNT=3|UMI=AC|SPBC=P|X=1", "seq2|GROUP=h|CONSCOUNT=1|SPBC=S"]
    assert got["visiumhd"] == ["seq1|GROUP=g|CONSCOUNT=3|UMI=AC|SPBC=P|X=1|BC2=b2", "seq2|GROUP=h|CONSCOUNT=1|SPBC=S"]


def test_run_that_moved(spark, tmp_path):
    old, new, away = tmp_path / "old", tmp_path / "new", tmp_path / "away.fa"
    old.mkdir()
    run = metadata.start_run(str(old), "1")
    assert metadata.start_run(str(old), "2") == run and [p.name for p in (old / metadata.FOLDER).iterdir()] == ["run.json"]
    for p in (old / "a.fa", away):
        p.write_text("x")
    t = ("2024-01-01T10:00:00+00:00", "2024-01-01T10:01:30+00:00")
    metadata.write_record(str(old), "filter", "run", {"input_reads": 4}, *t, files={"a": "a.fa", "b": str(old / "b.fa"), "c": str(away), "n": None})
    kinds = lambda root: {r[2].rsplit("/", 1)[-1]: r[3] for r in metadata.file_places(metadata.read_records(spark, str(root)), str(root))}
    assert kinds(old) == {"a.fa": "present", "b.fa": "missing", "away.fa": "present"}
    old.rename(new)
    assert kinds(new) == {"a.fa": "relocated", "b.fa": "missing", "away.fa": "present"}
    (tmp_path / "config.yaml").write_text("n: 1")
    assert metadata.copy_config(str(tmp_path / "config.yaml"), str(new)).read_text() == "n: 1"
    with pytest.raises(ValueError, match="neither"):
        metadata.report(spark, str(new), summary=False, page=False)
    metadata.report(spark, str(new), page=False)
    assert (new / "summary.tsv").exists() and not (new / "report.html").exists()


def test_streaming_decode(spark, tmp_path):
    from immunoframe.streaming import ingest

    b = "ACGTACGTACGTACGT"
    spark.createDataFrame([("r1", b + "A" * 12 + "GG", "I" * 30), ("r2", "T" * 30, "I" * 30)], "read_id string, sequence string, quality string").write.parquet(str(tmp_path / "in"))
    white = spark.createDataFrame([(b, 1, 2)], "spbc string, x int, y int")
    stream = ingest.decode(ingest.read_stream(spark, str(tmp_path / "in"), "read_id string, sequence string, quality string"), white, 20)
    q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("read_id", "status")) == [("r1", "pass"), ("r2", "fail")]
