"""Periodic runs, nearest neighbours and the prefix trie against plain versions, and on awkward rows."""

import glob
import hashlib
import os
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestead.llm import registry
from lodestead.llm.common import crc32_sql
from lodestead.llm.neighbours import best, fit_forest, nearest
from lodestead.llm.periodic import _collapsed, find_runs, periodic_runs, planted, run_digests, word_numbers
from lodestead.llm.prefix_trie import ZFastTrie, conversation_trie, numbered_turns, rebuilt, two_fattest

DATA = "/root/testdata/sf0.001"


def all_runs(words):
    """Every lag at every place."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - p:
            j = i
            while j < len(words) - p and words[j] == words[j + p]:
                j += 1
            if j - i >= max(p, 12 - p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e, q) for (s, e), q in found.items())


def texts_with_repeats(rnd):
    for _ in range(250):
        alphabet, kind = rnd.choice([1, 2, 2, 3, 10, 1000]), rnd.random()
        words = [rnd.randrange(alphabet) for _ in range(rnd.choice([0, 5, 20, 60, 150, 400]))]
        if kind < 0.5:  # repeats of repeats, some broken
            n, words = max(10, len(words)), []
            while len(words) < n:
                words += [rnd.randrange(alphabet) for _ in range(rnd.randint(1, 12))] * rnd.randint(1, 6)
                if rnd.random() < 0.5:
                    words += words[-rnd.randint(1, len(words)) :] * rnd.randint(1, 3)
                if rnd.random() < 0.3:
                    words[rnd.randrange(len(words))] = rnd.randrange(alphabet)
        elif kind < 0.6:  # Fibonacci words: as many runs as a text can have, about
            last, words = [0], [0, 1]
            while len(words) < 200:
                last, words = words, words + last
        yield words


def test_runs_against_all_lags():
    rnd = random.Random(1)
    texts = list(texts_with_repeats(rnd))
    for i in range(0, len(texts), 5):
        some = texts[i : i + 5]
        numbers, starts = word_numbers([" ".join(f"w{w}" for w in t).encode() for t in some])
        want = sorted((s + int(starts[k]), e + int(starts[k]), q) for k, t in enumerate(some) for s, e, q in all_runs(t))
        assert [tuple(r) for r in find_runs(numbers, starts).tolist()] == want


@pytest.mark.parametrize("words", [["a"] * 100_000, list("abcdefghij") * 10_000, sum(([f"u{i}", *"connection accepted from peer again and again now".split()] for i in range(10_000)), [])])
def test_runs_of_long_texts_take_few_extensions(words, monkeypatch):
    from lodestead.llm import periodic

    calls, same = [], periodic._same
    monkeypatch.setattr(periodic, "_same", lambda *a: calls.append(1) or same(*a))
    numbers, starts = word_numbers([" ".join(words).encode()])
    runs = periodic.find_runs(numbers, starts)
    assert len(calls) < len(words) // 2 and len(runs) == (1 if len(set(words)) < 11 else 0)


def test_a_long_text_is_cut_into_words_in_pieces(monkeypatch):
    from lodestead.llm import periodic

    text = b" x\ty\n" + b"one two  three\x0b" * 50 + b"end "
    whole, digest = word_numbers([text])[0].tolist(), _collapsed(text, np.zeros(153, bool))
    monkeypatch.setattr(periodic, "PIECE", 7)
    assert word_numbers([text])[0].tolist() == whole and len(whole) == 153
    assert _collapsed(text, np.zeros(153, bool)) == digest == b" ".join(text.split())


def test_periodic_runs_query_against_plain_python(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    got = {r["doc_id"]: r.asDict() for r in registry.op11_periodic_runs(spark, DATA).collect()}
    assert len(got) == len(docs)
    for d in docs:
        words = (d["text"] or "").encode().split()
        h, n = zlib.crc32(str(d["doc_id"]).encode()), len(words)
        if n > 3_000:
            continue
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = all_runs(words)
        gone = {i for s, e, q in runs for i in range(s + q, e)}
        top = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in sorted(runs, key=lambda r: (r[0], r[2])))
        assert got[d["doc_id"]] == {
            "doc_id": d["doc_id"], "n_runs": len(runs), "start": top and top[0], "length": top and top[1] - top[0], "period": top and top[2], "exponent_milli": top and 1000 * (top[1] - top[0]) // top[2],
            "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(), "collapsed_sha256": hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
        }


def test_periodic_runs_on_awkward_rows(spark):
    run = " ".join(["x y z"] * 6)
    rows = [(1, None, "r"), (2, "", "r"), (3, " \t\n", "r"), (None, run, "r"), (5, f"a {run} b", "r"), (5, f"a {run} b", "r"), (6, "Ünï \U0001f600 " * 7, "r"), (7, "w " * 300_000, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(3)
    got = {(r["doc_id"], len(r["collapsed"])): r for r in periodic_runs(docs).collect()}
    assert got[(None, 5)]["runs"] == [(0, 18, 3)] and got[(5, 9)]["runs"] == [(1, 18, 3)] and got[(5, 9)]["collapsed"] == "a x y z b"
    assert got[(1, 0)]["runs"] == got[(2, 0)]["runs"] == got[(3, 0)]["runs"] == []
    assert got[(6, 5)]["runs"] == [(0, 14, 2)] and got[(7, 1)]["runs"] == [(0, 300_000, 1)]
    assert periodic_runs(docs).count() == 8 and periodic_runs(docs.where("false")).count() == 0
    assert run_digests(periodic_runs(docs.withColumn("text", planted(F.col("doc_id"), F.col("text"))))).count() == 8


def cosine_search(rows, k=5, every=50):
    """Every query against every row, a pair at a time."""
    unit = [(i, np.array(v, float) / np.linalg.norm(np.array(v, float))) for i, v in rows]
    return {i: sorted(((-float(v @ w), j) for j, w in unit if j != i))[:k] for i, v in unit if i % every == 0}


def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(10, 32))
    data = [(i, (centres[i % 10] * 0.3 + rng.normal(size=32)).astype(np.float32).tolist()) for i in range(4_000)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(5)
    want = cosine_search(data)
    got = defaultdict(list)
    for r in nearest(df, least=500, leaf_rows=20, bough_rows=300, block_vectors=128, block_queries=16).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want) and all([r for r, _, _ in v] == [1, 2, 3, 4, 5] for v in got.values())
    assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for v in got.values() for a, b in zip(v, v[1:], strict=False))
    hits = sum(len({j for _, j in want[q]} & {v for _, v, _ in found}) for q, found in got.items())
    assert hits >= 0.9 * 5 * len(want)
    vectors = dict(data)
    for q, found in got.items():
        for _, v, score in found:
            a, b = np.array(vectors[q], float), np.array(vectors[v], float)
            assert abs(score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12
    # The same rows, whatever the partitions; and all leaves give the exact answer.
    again = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in nearest(df.repartition(3), least=500, leaf_rows=20, bough_rows=300, block_vectors=512).collect()}
    assert again == {(q, *x) for q, v in got.items() for x in v}
    exact = nearest(df, share=100.0).collect()
    assert {(r["query_id"], r["rank"]): r["vec_id"] for r in exact} == {(q, k + 1): j for q, found in want.items() for k, (_, j) in enumerate(found)}


def test_recall_on_the_given_vectors(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    want = {(q, j) for q, found in cosine_search(rows).items() for _, j in found}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for least in (4_096, 1):  # as registered, and with no more than the share
        got = {(r["query_id"], r["vec_id"]) for r in nearest(df, least=least, leaf_rows=20).collect()}
        assert len(got & want) >= (0.9 if least > 1 else 0.8) * len(want)


def test_forest_search_is_in_order_of_cost():
    rng = np.random.default_rng(1)
    sample = rng.normal(size=(2_000, 16))
    forest = fit_forest(sample, 3, 5)
    sizes = np.stack([np.bincount(c, minlength=32) for c in forest.leaves(sample).T])
    assert sizes.min() > 40  # medians: leaves of equal size
    gram = forest.directions.reshape(-1, 16) @ forest.directions.reshape(-1, 16).T
    assert np.allclose(np.diag(gram), 1) and np.isclose(np.abs(gram) < 1e-9, True).sum() >= 15 * 14
    places = forest.projected(sample[:1])[0]

    def cost(tree, leaf):
        node, total = leaf + 32, 0.0
        for level in reversed(range(5)):
            beyond = places[tree, level] - forest.thresholds[tree, node >> 1]
            total += beyond**2 if (beyond >= 0) != (node & 1) else 0.0
            node >>= 1
        return total

    order = forest.visited(places, sizes, sizes.sum())
    costs = [cost(*leaf) for leaf in order]
    assert len(set(order)) == 96 and costs == sorted(costs) and costs[0] == 0
    assert forest.visited(places, sizes, 1) == order[:1] and not fit_forest(sample[:0], 2, 3).thresholds.any()


def test_best_breaks_ties_by_id():
    one = np.array([[1.0, 0.0]])
    q, v, score = best(one, np.array([[0.6, 0.8], [1.0, 0.0], [1.0, 0.0], [1.0, 0.0]]), np.array([[True, True, True, False]]), np.array([1, 9, 4, 2]), 2)
    assert v.tolist() == [2, 1] and score.tolist() == [1.0, 1.0] and q.tolist() == [0, 0]


def test_neighbours_on_awkward_rows(spark):
    schema = "vec_id long, embedding array<float>, score string, leaf int"
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1e-3]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 0.0]), (50, [0.0, 2.0]), (50, [0.0, 2.0]), (100, [1.0, 2.0, 3.0]), (101, [1.0, 2.0, 2.0]), (8, [3e38, 3e38])]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], schema).repartition(3)
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in nearest(df).collect())
    assert got == [(0, 1, 1), (0, 2, 8), (0, 3, 50), (50, 1, 8), (50, 2, 1), (50, 3, 0), (100, 1, 101)]
    assert nearest(df.where("false")).count() == 0 and nearest(df.where("vec_id = 0")).count() == 0
    # Copies of one vector that make up most rows: ties go to the lesser ids, and no block holds all.
    many = [(i, [1.0, 0.0, 0.0]) for i in range(3_000)] + [(3_000 + i, [float(i), 1.0, 2.0]) for i in range(50)]
    copies = nearest(spark.createDataFrame(many, "vec_id long, embedding array<float>"), block_vectors=64).where("query_id < 3000").collect()
    assert len(copies) == 300 and all(r["vec_id"] == (r["rank"] - 1 if r["query_id"] > 0 else r["rank"]) and r["score"] == 1.0 for r in copies)
    # A row that is repeated counts once.
    same = nearest(spark.createDataFrame([(0, [1.0, 0.0])] * 40 + [(1, [1.0, 0.1])] * 40 + [(2, [0.0, 1.0])], "vec_id long, embedding array<double>")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in same] == [(0, 1, 1), (0, 2, 2)]


def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    given = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in convs.items()}
    made = {}
    for c, turns in given.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(given.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])[:h] + turns[h:])
    members, below = defaultdict(list), defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        if node:
            below[node[:-1]].append(node)
        leaves[node] = sum(leaves[k] for k in below[node]) or 1
        saved[node] = sum(saved[k] for k in below[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    ends = {n: hashlib.sha256(",".join(map(str, sorted(c for c in m if made[c] == n))).encode()).hexdigest() for n, m in members.items()}
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(below[n]), leaves[n], saved[n], ends[n]) for n, m in members.items()), key=repr)


def spark_trie(spark, rows, range_rows=50_000, **limits):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    return sorted(map(tuple, conversation_trie(rebuilt(numbered_turns(df, range_rows=range_rows)), range_rows=range_rows, **limits).collect()), key=repr)


def conversations(seed, most):
    rnd, rows = random.Random(seed), []
    for c in rnd.sample(range(-250, 600), 90):
        for t in range(rnd.choice([1, 2, 5, 9, most])):
            rows.append((c, t or None, "user" if t % 3 else rnd.choice(["user", "assistant", None]), rnd.choice(["a", "bb", "ccc", None, ""]) if t % 2 else "hello"))
    return rows


@pytest.mark.parametrize(("most", "limits"), [(3, {}), (60, {"sequence": 4, "batch_turns": 50, "range_rows": 40}), (30, {"sequence": 1, "batch_turns": 7, "range_rows": 100}), (40, {"sequence": 7, "batch_turns": 1_000, "range_rows": 1_000})])
def test_trie_against_all_prefixes(spark, most, limits):
    rows = conversations(most, most)
    assert spark_trie(spark, rows, **limits) == plain_trie(rows)


def test_trie_of_awkward_conversations(spark):
    rows = [(0, None, None, None), (0, 1, "", ""), (None, 1, "user", "no id"), (1, 1, "user", "\U0001f600é"), (1, 2, "user", "x"), (7, 1, "a:b", "c"), (8, 1, "a", "b:c")]
    rows += [(100 + c, t, "user", f"turn {t}") for c in range(1, 80) for t in range(8)]  # no 100: their own turns after the first h
    rows += [(300, t, "user", "again and again") for t in range(400)] + [(301, 3, "r", "t")] * 9  # one long, repeated rows
    rows += [(1_000 + 100 * k, d, "user", f"c{d}") for k in range(40) for d in range(40 - k)]  # each a prefix of the one before
    assert spark_trie(spark, rows, sequence=16, batch_turns=60, range_rows=64) == plain_trie(rows)
    assert spark_trie(spark, []) == [] and spark_trie(spark, [(None, 1, "a", "b")]) == []
    lone = spark_trie(spark, [(5, 0, "user", "x")])  # h of 5 is over 0: no turn is left
    assert lone == plain_trie([(5, 0, "user", "x")])


def test_exit_nodes_by_handles():
    rnd = random.Random(2)
    assert [two_fattest(a, b) for a, b in ((0, 1), (0, 5), (4, 6), (5, 7), (8, 15))] == [1, 4, 6, 6, 12]
    trie, told = ZFastTrie(), []
    for c in range(400):
        turns = [rnd.randrange(2) for _ in range(rnd.randint(0, 14))]
        prefixes = [hashlib.md5(repr(turns[:d]).encode()).digest() for d in range(len(turns) + 1)]
        trie.insert(c, 0, prefixes, np.zeros((len(turns) + 1, 3), np.int64), True)
        told.append(tuple(turns))
    nodes = [g for g in range(len(trie.name)) if trie.name[g] < trie.extent[g]]
    assert len(trie.handles) == len(trie.branches) == len(nodes)
    # Compacted: a node ends a conversation or has two branches.
    kids = defaultdict(int)
    for g in nodes:
        kids[trie._prefix(trie.of[g], trie.name[g])] += 1
    assert all(trie.ends.get(g) or kids[trie._prefix(trie.of[g], trie.extent[g])] > 1 for g in nodes)
    counted = {trie._prefix(of, trie.extent[g]): (members, least) for g, of, members, least in trie.expanded()}
    for text in set(told):
        same = [c for c, t in enumerate(told) if t[: len(text)] == text]
        assert counted[hashlib.md5(repr(list(text)).encode()).digest()] == (len(same), min(same))


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op13_prefix_trie"])
def test_twins(spark, name):
    con = duckdb.connect()
    for x in (0, 7, -7, 2**40):
        assert con.sql(f"SELECT {crc32_sql(f'({x})')}").fetchall() == [(zlib.crc32(str(x).encode()),)]
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df, twin = registry.queries()[name](spark, DATA), con.sql(registry.oracle_sql()[name])
    assert df.columns == twin.columns
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(twin.fetchall(), key=repr)
