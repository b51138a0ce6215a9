"""The training-text operators against SQL, brute force and hand-made edge cases."""

import collections
import hashlib
import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from compare import duck, same  # noqa: E402
from conftest import SF  # noqa: E402

from permaway.llm import decontaminate, fuzzylines, licenses, linehash, mixing, ngramjoin, quality, queries, shingles, suffixdedup, topk, toxicity  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, gone string, copy long, size int, rate double, _text string"


def make(spark, rows):
    """Documents of (doc_id, text, source), with columns whose names clash with those inside operators."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), "g", 9, 1, 0.5, "x") for i, t, s in rows], SCHEMA)


LONG = " ".join(f"word{i % 977} {i}" for i in range(30_000))
ODD = [(1, "same old text of a few words here\nand a line", "b"), (1, "same old text of a few words here\nand a line", "b"), (2, None, None), (3, "", "b"), (4, " \n\t", "a"), (5, LONG, "a"), (None, "same old text of a few words here\nand a line", "a"), (7, "short", ""), (8, "short", "é")]


@pytest.fixture(scope="module")
def odd(spark):
    return make(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return make(spark, []).where("false")


def frame(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def texts():
    return duck("SELECT doc_id, text FROM documents ORDER BY doc_id", SF)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    same(queries.QUERIES[name](spark, SF).toPandas(), duck(queries.SQL[name], SF))


def test_all_ten_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 11))


# 1 licences


def test_licences_are_found_and_inherited(spark, odd, empty):
    rows = [(100, "x\nReleased under the MIT License.\n", "s"), (101, "nothing here", "s"), (102, "Licensed under CC BY-NC 4.0. ", "s"), (250, "elsewhere", "s"), (300, "no licence in here", "t")]
    got = {r.doc_id: r for r in licenses.scan_licenses(make(spark, rows), licenses.document_path()).collect()}
    assert (got[100].license, got[100].basis) == ("MIT", "licence file")
    assert (got[101].effective_license, got[101].basis, got[101].source_dir) == ("MIT", "inherited", "/s/0/1")
    assert got[102].effective_license == "CC-BY-NC-4.0" and got[250].basis == "none"
    assert licenses.scan_licenses(odd, licenses.document_path()).count() == len(ODD)
    assert licenses.scan_licenses(empty, licenses.document_path()).count() == 0


def test_licence_of_the_nearest_directory(spark):
    rows = [("/a/LICENSE", "MIT", 0.9), ("/a/b/COPYING", "GPL-3.0", 0.8), ("/a/b/c/x.txt", None, None), ("/a/y.txt", None, None), ("/z.txt", None, None), (None, None, None)]
    got = {r.path: r.effective_license for r in licenses.inherit(spark.createDataFrame(rows, "path string, license string, score double")).collect()}
    assert (got["/a/b/c/x.txt"], got["/a/y.txt"], got["/z.txt"], got[None]) == ("GPL-3.0", "MIT", None, None)


def test_anchors_lose_nothing():
    t = licenses.Templates()
    for _, w in t.weights:
        assert sum(x * x for k, x in w.items() if k not in t.anchors) < licenses.THRESHOLD**2


# 2 quality


def test_quality_on_held_out(spark, odd, empty):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality.score_quality(docs, labels).toPandas().merge(duck("SELECT doc_id, quality FROM labels", d), on="doc_id")
    assert all(h == (quality.fold_number(i, 3) == 1) for i, h in zip(got.doc_id, got.held_out, strict=True))
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.95 and got.score.between(0, 1).all()
    assert quality.score_quality(odd, labels).count() == len(ODD)
    assert quality.score_quality(empty, labels).count() == 0
    none = labels.where("false")
    assert quality.score_quality(odd, none).where("score is null").count() == 0


def test_pu_risk_separates():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 0.5, (800, 3)), rng.normal(-1, 0.5, (800, 3))
    model = quality.nn_pu_fit(good[:400], np.vstack([good[400:], bad[:400]]), 0.5)
    assert (model.scores(good) > 0.5).mean() > 0.95 and (model.scores(bad) < 0.5).mean() > 0.95


# 3 suffix array


def windows(pieces, docs, n):
    low = {}
    for p, d in zip(pieces, docs, strict=True):
        for i in range(len(p) - n + 1):
            low[p[i : i + n]] = min(low.get(p[i : i + n], 1 << 60), d)
    return [[low[p[i : i + n]] for i in range(len(p) - n + 1)] for p in pieces]


def test_difference_cover_against_brute_force():
    rng = np.random.default_rng(5)
    for k in range(120):
        n = int(rng.integers(1, 9)) if k % 3 else 50
        letters = rng.integers(97, 97 + rng.integers(1, 4), 300).astype(np.uint8).tobytes()
        pieces = [letters[a : a + n + int(rng.integers(0, 30))] for a in rng.integers(0, 200, 10)]
        docs = rng.integers(0, 9, len(pieces))
        assert [x.tolist() for x in suffixdedup.least_docs(pieces, docs, n)] == windows(pieces, docs, n)


def test_repeated_seeds_against_brute_force():
    rng = np.random.default_rng(8)
    seen = 0
    for _ in range(300):
        common, unit = rng.integers(97, 123, 60).astype(np.uint8).tobytes(), rng.integers(97, 123, rng.integers(3, 21)).astype(np.uint8).tobytes()
        texts = [common + unit * 30, common + unit * int(rng.integers(3, 8))]
        at = {}
        for t, raw in enumerate(texts):
            for p in range(len(raw) - suffixdedup.SEED + 1):
                at.setdefault(raw[p : p + suffixdedup.SEED], [[], []])[t].append(p)
        for seed, (x, y) in at.items():
            if not x or not y:
                continue
            pieces = [raw[max(0, min(q) - 50 + suffixdedup.SEED) : max(q) + 50] for raw, q in zip(texts, (x, y), strict=True)]
            if min(map(len, pieces)) < 50:
                continue
            seen += len(x) != len(y)
            raw = np.frombuffer(seed, np.uint8)
            sums = np.cumsum(suffixdedup.BYTE[raw] * suffixdedup.powers(suffixdedup.BASE, len(raw)))[-1:]
            h = suffixdedup.mix(sums * suffixdedup.powers(suffixdedup.INVERSE, 1)).view(np.int64)
            lo, hi = suffixdedup.shared_parts(pieces, np.repeat(h, 2), 50)
            both = {pieces[0][i : i + 50] for i in range(len(pieces[0]) - 49)}
            for i in range(len(pieces[1]) - 49):
                w = pieces[1][i : i + 50]
                assert w not in both or seed not in w or lo[1] <= i < hi[1]
    assert seen


def test_suffix_ranks_sort():
    rng = np.random.default_rng(6)
    for n in (1, 2, 3, 4, 5, 17, 100, 301):
        t = rng.integers(1, 3, n)
        rank = suffixdedup.difference_cover_ranks(t, n)
        want = sorted(range(n), key=lambda i: t[i:].tolist())
        assert sorted(range(n), key=lambda i: rank[i]) == want


def removed(docs, n=50):
    first, out = {}, []
    for i, raw in sorted(docs, key=lambda d: d[0]):
        mask = np.zeros(len(raw) + 1, int)
        for p in range(len(raw) - n + 1):
            if first.setdefault(raw[p : p + n], i) < i:
                mask[p] += 1
                mask[p + n] -= 1
        gone = np.cumsum(mask[:-1]) > 0
        out.append((i, len(raw), int(gone.sum()), int(np.diff(np.r_[0, gone.astype(int)]).clip(0).sum()), hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


def dedup_rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


@pytest.mark.parametrize("hot", [8000, 1])
def test_substrings_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixdedup, "HOT", hot)
    docs = [(int(i), t.encode()) for i, t in texts().values]
    assert dedup_rows(suffixdedup.dedup_substrings(frame(spark, "documents"))) == removed(docs)


def test_substring_edges(spark, odd, empty):
    passage = "the very same passage of over fifty bytes stands in here, é"
    docs = [(3, "aa " + passage + " bb"), (1, passage), (2, "a" * 200), (9, "a" * 60 + "b"), (10, passage[:49]), (4, "zz " + passage)]
    got = suffixdedup.dedup_substrings(make(spark, [(i, t, "s") for i, t in docs]))
    assert dedup_rows(got) == removed([(i, t.encode()) for i, t in docs])
    by = {(r.doc_id, r.n_bytes): r for r in suffixdedup.dedup_substrings(odd).collect()}
    assert len(by) == 8 and all(r.n_removed == 0 for r in by.values())
    assert suffixdedup.dedup_substrings(empty).count() == 0


def test_packed_numbers():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000):
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        assert (suffixdedup.unpack(suffixdedup.pack(x)) == x).all()


# 4 decontamination


def test_windows_of_any_length(spark, odd, empty):
    items = spark.createDataFrame([("1", "Alpha beta"), ("2", "beta"), ("3", ""), ("4", None), ("5", "a b c d e f g h i j k"), ("5", "a b c d e f g h i j k"), (None, "zeta")], "item_id string, text string")
    docs = make(spark, [(1, "x ALPHA, beta! y", "s"), (4, "a b c d e f g h i j zz b c d e f g h i j k q", "s"), (6, "a b c d e f g h i", "s")])
    got = {r.doc_id: r for r in decontaminate.digest_query(docs, items).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].n_items, got[1].items_sha256) == (4, 2, 2, decontaminate.items_digest(["1", "2"]))
    assert (got[4].n_hit, got[4].n_items) == (20, 1) and not got[6].contaminated
    assert decontaminate.digest_query(odd, items).count() == len(ODD) and decontaminate.digest_query(empty, items).count() == 0
    assert decontaminate.digest_query(docs, items.where("false")).where("contaminated").count() == 0


def test_blocks_of_items_agree(spark, monkeypatch):
    docs, items = frame(spark, "documents"), frame(spark, "benchmark")
    one = decontaminate.digest_query(docs, items).toPandas()
    monkeypatch.setattr(decontaminate.benchmark_blocks, "__defaults__", (50,))
    same(decontaminate.digest_query(docs, items).toPandas(), one)


def test_blocks_give_one_answer(spark, monkeypatch):
    word = [f"w{i}" for i in range(400)]
    text = lambda *spans: " ".join(x for a, b in spans for x in word[a:b])
    items = [(1, text((0, 20))), (2, text((20, 40))), (3, text((100, 112))), (4, text((200, 206), (206, 212))), (5, "solo")]
    # 40 of 65 words in two items; a window of item 4 that arises from cutting item 3 out; two rows of an id.
    rows = [(1, text((0, 40), (300, 325)), "s"), (2, text((300, 330), (200, 206), (100, 112), (206, 212), (340, 370)), "s"), (3, text((300, 340), (0, 20)), "s"), (3, text((340, 380), (20, 40)), "s"), (4, "all of it solo here and so on", "s"), (5, None, "s"), (6, "", "s"), (7, text((300, 340)), "s")]
    items, docs = spark.createDataFrame(items, "item_id long, text string").repartition(1), make(spark, rows)
    one = [decontaminate.digest_query(docs, items).toPandas(), decontaminate.remove_contamination(docs, items).toPandas()]
    monkeypatch.setattr(decontaminate.benchmark_blocks, "__defaults__", (5,))
    assert len(list(decontaminate.benchmark_blocks(items))) > 3
    same(decontaminate.digest_query(docs, items).toPandas(), one[0])
    same(decontaminate.remove_contamination(docs, items).toPandas(), one[1])
    kept = one[1]
    assert sorted(kept.doc_id) == [2, 3, 3, 4, 5, 6, 7] and len(one[0]) == len(rows)
    assert decontaminate.digest_query(spark.createDataFrame(kept), items).where("contaminated").count() == 0


def test_passages_are_cut_out(spark, odd):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    around = " ".join(f"w{i}" for i in range(40))
    docs = make(spark, [(1, f"{around} One, two three four five six seven eight nine ten eleven. {around}", "s"), (2, "one two three four five six seven eight nine ten", "s"), (3, around, "s")])
    got = {r.doc_id: r for r in decontaminate.remove_contamination(docs, items).collect()}
    assert set(got) == {1, 3} and "three" not in got[1].text and got[1].text.startswith(around) and got[1].n_chars == len(got[1].text) and got[3].text == around
    assert decontaminate.remove_contamination(odd, items).count() == len(ODD)


# 5 n-gram join


def components(docs, k, num):
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[a : a + k]) for a in range(max(1, len(w) - k + 1))) if w else frozenset()
    ids, parent = sorted(sets), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and 100 * len(x & y) >= num * len(x | y):
                p, q = find(ids[a]), find(ids[b])
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("chunk", [150_000, 400])
def test_groups_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(ngramjoin, "CHUNK", chunk)
    rng = np.random.default_rng(2)
    base = [f"t{i}" for i in range(60)]
    docs = [(int(i), t) for i, t in texts().values]
    for i in range(40):
        w = list(base)
        for j in rng.integers(0, 60, rng.integers(0, 4)):
            w[j] = f"x{rng.integers(0, 30)}"
        docs.append((100_000 + i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.near_groups(make(spark, [(i, t, "s") for i, t in docs])).collect()}
    assert got == components(docs, 4, 85)


def test_group_edges(spark, odd, empty):
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngramjoin.near_groups(odd).collect())
    assert len(got) == len(ODD) and ("8", 1, "7") in got and got.count(("1", 8, "1")) == 2 and ("None", 8, "1") in got and ("3", 0, "3") in got and ("2", 0, "2") in got
    assert ngramjoin.near_groups(empty).count() == 0
    assert {r.doc_id for r in ngramjoin.keep_first(odd.where("doc_id in (7, 8)")).collect()} == {7}


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    whole = shingles.word_hashes(LONG.encode())
    monkeypatch.setattr(shingles, "PIECE", 1000)
    assert (shingles.word_hashes(LONG.encode()) == whole).all() and len(whole) == 60_000


# 6 top k


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(rng.normal(0, 1, 20), 1)]) for i in range(400)] + [(1000 + i, [1.0] * 20) for i in range(12)]
    rows += [(2000, None), (2001, [float("nan")] * 20), (2002, [None] + [1.0] * 19), (2050, [0.5] * 3), (2003, [0.25] * 3), (2004, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block in (16_384, 2):
        got = topk.top_k(df, lambda i: i % 50 == 0, query_block=block).collect()
        q = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in rows if v and None not in v and np.isfinite(v).all()}
        want = []
        for i in (i for i in q if i % 50 == 0):
            best = sorted((-int(q[i] @ q[j]), j) for j in q if j != i and len(q[j]) == len(q[i]))[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
        assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(df.where("false"), lambda i: i % 50 == 0).count() == 0


def test_wide_vectors_and_repeated_rows(spark):
    rows = [(0, [1.0, -2.0, 0.5]), (1, [float(1 << 21), 0.0, 1.0]), (2, [3e9, 3e9, 3e9]), (3, [1e30, 0.0, 0.0]), (4, [1.0, 1.0, 1.0]), (50, [float(1 << 22), 1.0, 0.0]), (5, [2e30, -1e12, 0.0]), (6, [-1e25, 0.0, 0.0])]
    rows += [(7, [9.0, 9.0, 9.0])] * 9 + [(8, [1.0, 2.0, 3.0]), (9, [1.0, 2.0, 2.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), lambda i: i % 50 == 0).collect()
    q = {i: [int(np.floor(256 * x)) if abs(x) < 1e12 else int(256 * x) for x in v] for i, v in rows}
    want = []
    for i in (0, 50):
        best = sorted((-sum(a * b for a, b in zip(q[i], q[j], strict=True)), j) for j in q if j != i)[:5]
        want += [(i, k + 1, j, min(max(-s, topk.LEAST), topk.MOST)) for k, (s, j) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)


# 7 fuzzy lines


def test_fuzzy_lines_against_brute_force(spark):
    got = fuzzylines.dedup_lines_fuzzy(frame(spark, "documents")).toPandas()
    lines = [(int(i), p, s.lower().strip(fuzzylines.BLANKS)) for i, t in texts().values for p, s in enumerate(t.split("\n")) if s.strip(fuzzylines.BLANKS)]
    first = {}
    for i, p, s in lines:
        first.setdefault(s, (i, p))
    names = list(first)
    sets = [frozenset(s[a : a + 5] for a in range(max(1, len(s) - 4))) for s in names]
    parent = list(range(len(names)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = collections.defaultdict(list)
    for i, x in enumerate(sets):
        for g in x:
            where[g].append(i)
    for i, x in enumerate(sets):
        for j, n in collections.Counter(j for g in x for j in where[g] if j > i).items():
            if n >= 0.8 * (len(x) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    keep = {}
    for i, s in enumerate(names):
        keep[find(i)] = min(keep.get(find(i), first[s]), first[s])
    number = {s: i for i, s in enumerate(names)}
    want = {(i, p) for i, p, s in lines if keep[find(number[s])] != (i, p)}
    mine = {(int(i), int(p)) for i, g in zip(got.doc_id, got.removed_lines, strict=True) for p in g}
    assert not mine - want and len(want - mine) <= 0.02 * len(want)


def test_fuzzy_line_edges(spark, odd, empty):
    line = "a rather long line that is repeated with one small change in it somewhere near the end of it"
    rows = [(1, line + "\n\nother", "s"), (2, "first\n" + line.replace("small", "smell"), "s"), (3, line.upper(), "s")]
    got = {r.doc_id: r for r in fuzzylines.dedup_lines_fuzzy(make(spark, rows)).collect()}
    assert got[1].n_removed == 0 and got[2].text == "first" and got[3].text == "" and got[3].n_lines == 1
    out = fuzzylines.dedup_lines_fuzzy(odd)
    assert out.count() == len(ODD) and {"n_lines", "removed_lines", "gone", "_text"} <= set(out.columns)
    assert fuzzylines.dedup_lines_fuzzy(empty).count() == 0


def test_rows_of_one_id_keep_their_own_lines(spark):
    rows = [(1, "a line that both of them have\nno other has this one", "s"), (1, "an entirely unique sentence here\na line that both of them have", "s"), (2, "x\r\n\r\ny of some words\r\n\r\n", "s"), (3, "y of some words", "s")]
    fuzzy = {r.text for r in fuzzylines.dedup_lines_fuzzy(make(spark, rows)).collect()}
    exact = {r.text for r in linehash.dedup_lines_exact(make(spark, rows)).collect()}
    for got in (fuzzy, exact):
        assert sum("that both of them have" in t for t in got) == 1 and sum("an entirely unique sentence here" in t for t in got) == 1 and sum("no other has this one" in t for t in got) == 1
        assert rows[2][1] in got and "" in got


def test_large_groups_and_mixed_buckets(spark):
    rng = np.random.default_rng(4)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 7))
    base = [word() for _ in range(30)]
    lines = []
    for i in range(120):
        w = list(base)
        for j in rng.choice(30, 2 if i < 60 else 6, replace=False):
            w[j] = word()
        lines.append(" ".join(w))
    sets = [frozenset(s[a : a + 5] for a in range(len(s) - 4)) for s in lines]
    parent = list(range(len(lines)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(lines)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    got = fuzzylines.dedup_lines_fuzzy(make(spark, [(i, t, "s") for i, t in enumerate(lines)]))
    gone = {r.doc_id for r in got.where("n_removed > 0").collect()}
    assert len(gone ^ {i for i in range(len(lines)) if find(i) != i}) <= 2


def test_edits_at_word_starts_are_found(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(150):
        words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(3, 10))) for _ in range(30)]
        near, sets = " ".join(words), lambda t: {t[a : a + 5] for a in range(len(t) - 4)}
        for w in rng.permutation(30):
            words[w] = "#" + words[w][1:]
            t, x = " ".join(words), sets(" ".join(words))
            if len(x & sets(near)) < 0.8 * len(x | sets(near)):
                break
            last = t
        rows += [(2 * i, near, "s"), (2 * i + 1, last, "s")]
    got = fuzzylines.dedup_lines_fuzzy(make(spark, rows))
    assert got.where("n_removed > 0").count() >= 0.93 * 150


def test_lines_without_blanks_are_found(spark):
    rng = np.random.default_rng(12)
    tail = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 70))
    lines = ["https://example.org/one/path/that/all/of/the/lines/have/" + tail() for _ in range(60)]
    lines += ["".join(chr(0x4E00 + c) for c in rng.integers(0, 3000, 60)) for _ in range(20)]
    rows = [(i, t, "s") for i, t in enumerate(lines)] + [(100 + i, t[:-1] + "!", "s") for i, t in enumerate(lines)]
    got = fuzzylines.dedup_lines_fuzzy(make(spark, rows)).where("n_removed > 0")
    assert sorted(r.doc_id for r in got.collect()) == list(range(100, 180))


def test_texts_are_hashed_once_and_not_once_a_line(spark):
    plan = fuzzylines.lines_of(make(spark, [(1, "a\nb", "s")]))._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate")]
    assert "text#" not in above and "AS r1" not in above


def test_copies_of_a_text_are_not_signed_again(spark, monkeypatch):
    rows = [(i, "one line of copies\nanother of them, longer", "s") for i in range(60)] + [(None, "one line of copies\nanother of them, longer", "s"), (70, None, "s"), (71, "one line of copiez\nby itself", "s")]
    signed, sign = [], fuzzylines.signatures

    def counted(lines, k):
        signed.append(lines.count())
        return sign(lines, k)

    monkeypatch.setattr(fuzzylines, "signatures", counted)
    got = {r.doc_id: r.removed_lines for r in fuzzylines.dedup_lines_fuzzy(make(spark, rows)).collect()}
    # A bit that two keys share lets a copy through now and then.
    assert 4 <= max(signed) <= 10
    assert got == {None: [], 70: [], 71: [0]} | {i: [0, 1] for i in range(60)}


def test_texts_are_folded_for_keys_and_signatures_alone(spark, monkeypatch):
    rng = np.random.default_rng(15)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 7))
    base = [" ".join(word() for _ in range(30)) for _ in range(3)]
    # What ends in a capital sigma folds alike within the text and by itself.
    rows = [(i, f"{base[i % 3]} \u039f\u03a3\n{word()} by itself\n \t", "s") for i in range(3)] + [(3 + i, f"own {word()}\n{base[i]} {word()} \u039f\u03a3", "s") for i in range(3)]
    plans, write = [], fuzzylines.cut

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df)

    monkeypatch.setattr(fuzzylines, "cut", seen)
    monkeypatch.setattr(fuzzylines, "settle", lambda make: seen(make()))
    got = {r.doc_id: r.removed_lines for r in fuzzylines.dedup_lines_fuzzy(make(spark, rows)).collect()}
    assert got == {i: [] for i in range(3)} | {3 + i: [1] for i in range(3)}
    assert sum("lower(text#" in x for x in plans) == 2 and sum("lower(line#" in x for x in plans) >= 1


def test_lines_that_borrow_agree_with_those_that_fill_all_bins(spark):
    rng = np.random.default_rng(16)
    lines = ["".join(chr(0x4E00 + c) for c in rng.integers(0, 20000, n)) for n in rng.integers(90, 160, 400)]
    rows = [(2 * i + j, x[: len(x) - 6 * j], "s") for i, x in enumerate(lines) for j in (0, 1)]
    kept = fuzzylines.lines_of(make(spark, rows))
    sign = {(r.h1, r.h2): r for r in fuzzylines.signatures(kept, 5).collect()}
    of = {r.doc_id: sign[r.h1, r.h2] for r in kept.collect()}
    agree = []
    for i in range(400):
        x, y = of[2 * i], of[2 * i + 1]
        d = [(a ^ b) & (2**64 - 1) for a, b in ((x.s1, y.s1), (x.s2, y.s2))]
        agree.append(sum(not v >> 4 * j & 15 for v in d for j in range(16)))
    assert len(of[0].bands) == len(fuzzylines.BANDS) and np.mean(agree) >= 29 and min(agree) >= 20


def test_short_lines_meet_as_often_as_they_are_alike(spark):
    """Sets of five of which two share four, as bands and AGREE let them through."""
    rng = np.random.default_rng(13)
    words = ["".join(chr(0x4E00 + c) for c in rng.integers(0, 20000, 9)) for _ in range(1500)]
    rows = [(2 * i + j, w[: 9 - j], "s") for i, w in enumerate(words) for j in (0, 1)]
    lines = fuzzylines.lines_of(make(spark, rows))
    sign = {(r.h1, r.h2): r for r in fuzzylines.signatures(lines, 5).collect()}
    of = {r.doc_id: sign[r.h1, r.h2] for r in lines.collect()}
    met = 0
    for i in range(1500):
        x, y = of[2 * i], of[2 * i + 1]
        d = [(a ^ b) & (2**64 - 1) for a, b in ((x.s1, y.s1), (x.s2, y.s2))]
        met += bool(set(x.bands) & set(y.bands)) and sum(not v >> 4 * j & 15 for v in d for j in range(16)) >= fuzzylines.AGREE
    assert met >= 0.98 * 1500


def test_marks_lose_no_pair_and_tell_most_others(spark):
    """Pairs around the threshold, short and long, of which the marks stand before the exact comparison."""
    rng = np.random.default_rng(17)
    lines = []
    for i in range(300):
        x = [chr(97 + c) for c in rng.integers(0, 26, (4, 30, 200, 500, 900)[i % 5])]
        y = list(x)
        for j in rng.choice(len(y), int(len(y) * (0, 0.02, 0.023, 0.05, 0.06)[i // 5 % 5]), replace=False):
            y[j] = "\u00e9"
        lines += ["".join(x), "".join(y)]
    # Repeats count once in a set, but in every window: such pairs may pass.
    lines += ["abcab" * 60, "abcab" * 90, "-" * 500, "-" * 400 + "+"]
    texts = spark.createDataFrame(list(enumerate(lines)), "id bigint, line string")
    marks = fuzzylines.marks_of(texts, 5)
    x, y = (marks.selectExpr(f"id as id{n}", f"marks as marks{n}", f"windows as windows{n}") for n in "xy")
    passed = {r.idx for r in x.join(y, F.expr("idx % 2 = 0 and idy = idx + 1")).where(fuzzylines._near(0.8)).collect()}
    sets = [{s[a : a + 5] for a in range(max(1, len(s) - 4))} for s in lines]
    alike = {i: len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, len(lines), 2)}
    assert {i for i, s in alike.items() if s >= 0.8} <= passed and sum(s >= 0.8 for s in alike.values()) >= 150
    under = [i for i, s in alike.items() if s < 0.7 and i < 600]
    assert len(under) >= 80 and not passed & set(under)


def test_trimming_walks_through_no_line_without_blanks_at_its_ends(spark):
    odd = ["", " ", "\t\x0b\r", " a", "a\x0c", "a b", "\u00a0a\u3000", "\r a \t b\x0b ", None]
    t = spark.createDataFrame([(x,) for x in odd], "line string").select("line", fuzzylines.trimmed("line").alias("t"))
    assert [r.t for r in t.collect()] == [x if x is None else x.strip(fuzzylines.BLANKS) for x in odd]
    plan = fuzzylines.lines_of(make(spark, [(1, "a\nb", "s")]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(") == plan.count("THEN trim(") + plan.count("THEN btrim(") > 0


# 8 line hashing


def test_line_hash_edges(spark, odd, empty):
    rows = [(1, "A  line\nb\n\nA line", "s"), (2, "a line \nc\r\n", "s")]
    got = {r.doc_id: r for r in linehash.dedup_lines_exact(make(spark, rows)).collect()}
    assert got[1].text == "A  line\nb\n" and [(s.start, s.stop) for s in got[1].removed_spans] == [(11, 17)]
    assert got[2].text == "c\r\n" and got[2].removed_chars == 7
    out = linehash.dedup_lines_exact(odd)
    assert out.count() == len(ODD) and {"gone", "_text", "n_units"} <= set(out.columns) and linehash.dedup_lines_exact(empty).count() == 0


def test_passages_within_lines_go(spark):
    passage = "Some words that are the same in both of them. And é here the second sentence of the passage is."
    rows = [(1, f"Before it stands this. {passage} After it that", "s"), (2, f"Another start of nine words in the other document. {passage} Ok.", "s"), (3, passage.split(". ")[0].upper() + ". ", "s")]
    got = {r.doc_id: r for r in linehash.dedup_lines_exact(make(spark, rows)).collect()}
    assert got[1].n_removed == 0 and got[1].text == rows[0][1]
    assert got[2].text == "Another start of nine words in the other document. Ok." and (got[2].n_units, got[2].n_removed) == (4, 2)
    assert "".join(rows[1][1][s.start : s.stop] for s in got[2].removed_spans) == " " + passage
    assert got[3].text == "" and got[3].n_removed == 1


# 9 mixing


def test_mix_edges(spark, odd, empty):
    plan = mixing.plan_mix(odd).toPandas()
    assert len(plan) == len(ODD) and (plan.copies <= 3).all() and (plan.target <= 3 * plan.source_size).all()
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0
    assert mixing.mix(odd).count() == plan.copies.sum()


def test_targets_are_shared_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 50)], "source string, size long")
    t = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert t["a"] == 30 and t[None] == 150 and sum(t.values()) == pytest.approx(2060) and t["b"] == pytest.approx(2 * t["c"])


def test_every_source_comes_near_its_target(spark):
    d = "/root/testdata/sf0.01"
    plan = mixing.plan_mix(spark.read.parquet(f"{d}/documents.parquet")).toPandas().merge(duck("SELECT doc_id, source FROM documents", d), on="doc_id")
    per = plan.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert len(per) == 20 and (abs(per.taken - per.target) <= 0.05 * per.target).all()
    assert (plan.copies <= 3).all() and (plan.copies >= np.floor(plan.target / plan.source_size)).all() and (plan.copies <= np.floor(plan.target / plan.source_size) + 1).all()


def test_copy_takes_a_new_name(spark, odd):
    assert mixing.mix(odd.withColumn("_copy", F.lit(1))).columns[-1] == "__copy" and mixing.mix(odd).columns[-1] == "_copy"


def test_mix_joins_many_sources(spark, monkeypatch, odd):
    one = mixing.plan_mix(odd).toPandas()
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    same(mixing.plan_mix(odd).toPandas(), one)


# 10 toxicity


def test_words_are_restored(spark):
    words = "idiot loser moron pathetic other words that stand here for the model to learn from".split()
    docs = make(spark, [(i, " ".join(words[i % 7 :]), "s") for i in range(200)])
    model = toxicity.log_model(toxicity.trigram_counts(docs))
    assert [toxicity.restore(t, model) for t in ("1d10t", "l0ser", "mooooron", "i d i o t", "p@thet1c", "m-o-r-o-n")] == ["idiot", "loser", "moron", "idiot", "pathetic", "moron"]
    assert toxicity.disguised(b"the 1d10t, s-t-u-p-i-d! stuuuupid THE!! thnd*** of$$$ a b 12") == ["1d10t", "stuuuupid", "of$$$", "s-t-u-p-i-d", "t-u-p-i-d"]
    assert toxicity.disguised(b"a$$ as5 bitc# no! well idiot!!") == ["a$$", "as5", "bitc#"]
    r = toxicity.Restorer(model)
    assert b"idiot" in r.words(b"an idio7 there") and b"moron" in r.words(b"m" + b"o" * 200 + b"ron")
    spaced = " ".join("thatidiotstandsherewithotherwordsforthemodeltolearnfromandmore").encode()
    assert any(w.startswith(b"idiot") for w in r.words(spaced))


def test_toxicity_on_held_out(spark, odd, empty):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = toxicity.score_toxicity(docs, labels).toPandas().merge(duck("SELECT doc_id, toxic FROM labels", d), on="doc_id")
    held = got[got.held_out]
    assert (held.predicted == held.toxic).mean() > 0.97 and got.score.between(0, 1).all()
    trained = toxicity.train_toxicity(docs, labels)
    assert toxicity.with_toxicity(odd, trained).where("score is null").count() == 0
    hidden = make(spark, [(1, "there is an 1d10t and a l0s3r, a m o r o n with stuuupid tr@sh and sc*m", "s"), (2, "and then they went on to the other", "s")])
    scores = {r.doc_id: r.score for r in toxicity.with_toxicity(hidden, trained).collect()}
    assert scores[1] > 0.5 > scores[2]
    assert toxicity.score_toxicity(odd, labels.where("false")).count() == len(ODD)
    assert toxicity.score_toxicity(empty, labels).count() == 0


# pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs, items = frame(spark, "documents"), frame(spark, "benchmark")
    columns = docs.columns
    seen = {}
    for name, stage in p.STAGES:
        before = docs
        docs = p.cut(stage(spark, docs, SF))
        seen[name] = (before, docs)
        assert name == "mixing" or docs.columns == columns
    before, after = seen["toxicity"]
    scores = toxicity.with_toxicity(before, toxicity.train_toxicity(before, frame(spark, "labels")), "s")
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scores.where("s < 0.5").collect()}
    before, after = seen["ngram_join"]
    groups = components([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in groups.items() if c == i}
    before, after = seen["decontamination"]
    assert decontaminate.digest_query(after, items).where("contaminated").count() == 0
    clean = {r.doc_id for r in decontaminate.digest_query(before, items).where("not contaminated").collect()}
    assert clean <= {r.doc_id for r in after.collect()}
    before, after = seen["mixing"]
    assert after.count() == mixing.plan_mix(before).agg(F.sum("copies")).first()[0]


def test_pipeline_takes_odd_rows(spark, odd):
    import corpus_pipeline as p

    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in p.STAGES:
        docs = p.cut(stage(spark, docs, SF))
    assert docs.where("text is null").count() <= 3
