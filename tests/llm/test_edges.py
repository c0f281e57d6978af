"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lodestead.llm import registry
from lodestead.llm.chat_format import repair_roles
from lodestead.llm.decontaminate import benchmark_hits
from lodestead.llm.html_extract import extract_text
from lodestead.llm.language import identify_languages
from lodestead.llm.mixing import mix_to_weights
from lodestead.llm.near_dedup import near_duplicates
from lodestead.llm.spotsigs import fingerprint_documents, near_pairs
from lodestead.llm.suffix_dedup import remove_repeats
from lodestead.llm.toxicity import score_toxicity
from lodestead.llm.url_filter import filter_urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, uid string, component string, seq string"
LONG = " ".join(f"word{i % 977} item{i % 31}" for i in range(40_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here", "en", "a", 1, "x", "y", "z", "s"),
    (2, None, None, None, None, None, None, None, None),
    (3, "", "en", "a", 0, "", "", "", ""),
    (4, "The quick brown fox jumps over the lazy dog and runs far away from here", None, None, 1, "x", "y", "z", "s"),
    (4, "The quick brown fox jumps over the lazy dog and runs far away from here", None, None, 1, "x", "y", "z", "s"),
    (5, LONG, "en", "b", 9, "x", "y", "z", "s"),
    (None, "a text without an id that is long enough to hold a window of fifty bytes", "en", "c", 1, "x", "y", "z", "s"),
    (7, "%%% ### 123", "en", None, 1, "x", "y", "z", "s"),
    (8, "Ünïcödé \U0001f600 и кириллица тоже", "ru", "c", 1, "x", "y", "z", "s"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_near_dedup(docs, none):
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect())
    assert len(got) == len(ROWS)
    assert (1, 11, 1, True) in got and got.count((4, 11, 1, False)) == 2
    assert (2, 0, 2, True) in got and (3, 0, 3, True) in got and (7, 1, 7, True) in got
    assert [g for g in got if g[0] == 0] == [(0, 12, None, False)]
    assert near_duplicates(none).count() == 0


def test_near_dedup_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(k, " ".join(base[:k % 7] + [f"x{k}"] + base[k % 7 + 1 :])) for k in range(80)] + [(100 + k, f"alone {k} " + " ".join(f"u{k}_{i}" for i in range(30))) for k in range(20)]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k] == 0 for k in range(80)) and all(got[100 + k] == 100 + k for k in range(20))


def test_decontamination(spark, docs, none):
    bench = spark.createDataFrame([("i1", "quick BROWN fox jumps over the lazy dog and runs far away"), ("i2", "lazy-dog"), ("i3", None), (None, ""), ("i4", "nowhere to be found")], "item_id string, text string")
    for block in (200_000, 1):
        got = {(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in benchmark_hits(docs, bench, block=block).collect()}
        digest = hashlib.sha256(b"i1,i2").hexdigest()
        assert {(1, 15, 12, 2, digest, True), (4, 15, 12, 2, digest, True), (2, 0, 0, 0, hashlib.sha256(b"").hexdigest(), False)} <= got
    assert benchmark_hits(none, bench).count() == 0 and benchmark_hits(docs, bench.limit(0)).where("contaminated").count() == 0


def brute_repeats(rows):
    texts = sorted((d, (t or "").encode()) for d, t in rows if d is not None)
    out = {}
    for d, t in texts:
        hit = [False] * len(t)
        for p in range(len(t) - 49):
            if any(e < d and t[p : p + 50] in u for e, u in texts):
                hit[p : p + 50] = [True] * 50
        kept = bytes(b for b, h in zip(t, hit, strict=True) if not h)
        spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        out[d] = (len(t), sum(hit), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("heavy", "crowd"), [(10_000, 4_096), (1, 4_096), (10_000, 2), (1, 2)])
def test_suffix_dedup(spark, heavy, crowd):
    import random

    rng = random.Random(5)
    passage = "".join(rng.choice("abcdé ") for _ in range(90))
    rows = [(k, "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 120))) + passage[rng.randint(0, 30) :] + "".join(rng.choice("xyz ü") for _ in range(rng.randint(0, 80)))) for k in range(60)]
    rows += [(90, rows[0][1]), (91, None), (92, ""), (93, "a" * 400), (94, "a" * 300)]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), group_bytes=3000, heavy=heavy, crowd=crowd).collect()}
    assert got == brute_repeats(rows)


@pytest.mark.parametrize("size", [31, 49, 64])
def test_suffix_dedup_of_a_phrase_between_values(spark, size):
    import random

    rng = random.Random(size)
    phrase = "".join(rng.choice("abcdefgh ") for _ in range(size))
    rows = [(k, "".join(f"{rng.randrange(10**9):09d}{rng.randrange(10**9):09d}{phrase}{rng.randrange(300):03d}x{rng.randrange(10**20):020d}\n" for _ in range(8))) for k in range(60)]
    rows += [(200, rows[5][1][30:190]), (201, "0" + rows[7][1])]
    want = brute_repeats(rows)
    for crowd in (4, 64):
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), group_bytes=5000, crowd=crowd).collect()}
        assert got == want


def test_suffix_dedup_deals_out_templated_lines_evenly(spark, monkeypatch):
    from lodestead.llm import suffix_dedup
    from lodestead.llm.common import written

    line = "concat(substr(md5(concat('a', {0})), 1, 28), ' connection accepted from peer ', substr(md5(concat('b', {0})), 1, 30))".format("cast(id * 20 + k as string)")
    docs = spark.range(0, 10_000, 1, 8).selectExpr("id as doc_id", f"array_join(transform(sequence(0, 19), k -> {line}), '\n') as text")
    size = 10_000 * (20 * 89 - 1)
    real = docs.selectExpr("xxhash64(doc_id, text) as uid", "doc_id", "text")
    marks = suffix_dedup._marks(real, suffix_dedup.CHUNK_BYTES, suffix_dedup.CROWD)
    groups = size // 500_000
    entries = real.mapInArrow(suffix_dedup._entries(groups, suffix_dedup.CHUNK_BYTES, marks), suffix_dedup._ENTRY)
    buckets = sorted(r["n"] for r in entries.groupBy("bucket").agg(F.sum(F.octet_length("anchors")).alias("n")).collect())
    assert len(buckets) == groups and buckets[-1] <= 3 * buckets[len(buckets) // 2]
    kept = []
    monkeypatch.setattr(suffix_dedup, "written", lambda df, name: kept.append(written(df, name)) or kept[-1])
    total = suffix_dedup.remove_repeats(docs).agg(F.sum("n_removed"), F.count("*")).first()
    assert tuple(total) == (0, 10_000)
    # Contexts that share an anchor by chance of a few digits; none is compared window by window.
    found = kept[-1].groupBy("kind").agg(F.sum(F.octet_length("data")).alias("n")).collect()
    assert [r["kind"] for r in found] == [1] and found[0]["n"] < size // 2 and sum(df.count() for df in kept[:-1]) < 100


def test_suffix_dedup_many_places_in_one_document(spark):
    line = "2024-01-01 00:00:00 worker-7 INFO heartbeat received, queue empty\n"
    rows = [(1, "x" + "-" * 100_000 + "y"), (2, "front " + "-" * 120 + " back"), (3, "z" * 10 + "-" * 90_000), (4, line * 50_000), (5, "before it " + line[:-1] + "; after it " + line + "end"), (5, "other row of five " + line)]
    rows += [(3, rows[2][1])] * 2
    least: dict[bytes, int] = {}
    for d, t in sorted(rows):
        t = t.encode()
        for p in range(len(t) - 49):
            least.setdefault(t[p : p + 50], d)
    want = []
    for d, t in rows:
        t = t.encode()
        hit = bytearray(len(t))
        for p in range(len(t) - 49):
            if least[t[p : p + 50]] < d:
                hit[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, h in zip(t, hit, strict=True) if not h)
        want.append((d, len(t), sum(hit), hashlib.sha256(kept).hexdigest()))
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    assert sorted(got) == sorted(want)


def test_suffix_dedup_edges(docs, none):
    got = {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in remove_repeats(docs, carry=("lang", "size")).collect()}
    assert {(1, 71, 0), (4, 71, 71), (2, 0, 0), (3, 0, 0), (None, 72, 0)} <= got
    assert remove_repeats(none).count() == 0


def test_mixing_of_one_doc_id_does_not_depend_on_partitions(spark):
    rows = [(1, f"word{k} of two", "a", k) for k in range(50)] + [(2, "some words", "b", 99)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, tie long")
    first, second = ({(r["tie"], r["taken"]) for r in mix_to_weights(f, carry=("tie",)).collect()} for f in (frame.coalesce(1), frame.orderBy(F.desc("tie")).repartition(5)))
    assert first == second and len(first) == 51


def test_spotsigs(docs, none, spark):
    got = {r["doc_id"]: r for r in fingerprint_documents(docs).collect()}
    assert len(got) == 8 and got[2]["fingerprint"] == "" and got[1]["fingerprint"] == got[4]["fingerprint"] != ""
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got.values())
    order = sorted((d for d in got if d is not None), reverse=True) + [None]
    texts = {r[0]: r[1] or "" for r in ROWS}
    d, after = 1, order[(order.index(1) + 1) % len(order)]
    half = len(texts[d]) // 2
    assert got[d]["edited_sha256"] == hashlib.sha256((texts[d][: len(texts[d]) - half] + texts[after][:half]).encode()).hexdigest()
    assert fingerprint_documents(none).count() == 0
    words = [f"the tree{i} and house{i}" for i in range(40)]
    pairs = near_pairs(spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:-1])), (3, "of all things other")], "doc_id long, text string")).collect()
    assert [(r["a"], r["b"]) for r in pairs] == [(1, 2)] and pairs[0]["near"] > 0.9


def test_language(docs, none):
    got = {r["doc_id"]: r for r in identify_languages(docs, docs).collect()}
    assert got[2]["lang_pred"] == got[3]["lang_pred"] == got[7]["lang_pred"] == "und"
    assert got[8]["lang_pred"] == "ru" and got[1]["lang_pred"] == "en" and 0 < got[8]["score"] <= 1
    assert identify_languages(none).count() == 0 and {r["lang_pred"] for r in identify_languages(docs, none).collect()} == {"und"}


def test_language_of_rare_scripts(spark):
    import random

    rng = random.Random(3)
    # Languages of equal word lengths with letters of their own; the two Chinese-like ones take all frequent places.
    alphabets = {"zh": [chr(0x4E00 + k) for k in range(400)], "ja": [chr(0x5E00 + k) for k in range(400)], "el": "αβγδεζηθικλμνξοπρστυφχψω", "th": [chr(0x0E01 + k) for k in range(40)], "got": [chr(0x10330 + k) for k in range(20)], "osa": [chr(0x104D8 + k) for k in range(20)]}
    words = {lang: ["".join(rng.choice(letters) for _ in range(4)) for _ in range(60)] for lang, letters in alphabets.items()}
    langs = ["zh"] * 480 + ["ja"] * 480 + ["el", "th", "got", "osa"] * 10
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(12)), lang) for i, lang in enumerate(langs)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r["doc_id"]: r["lang_pred"] for r in identify_languages(frame).collect()}
    assert got == dict(enumerate(langs))


def test_mixing(docs, none, spark):
    rows = [(r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in mix_to_weights(docs).collect()]
    assert len(rows) == len(ROWS) and all(0 <= r[4] <= 3 * r[1] for r in rows)
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(id % 13 as int))").alias("text"), F.expr("case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else concat('s', id % 7) end").alias("source"))
    got = mix_to_weights(many)
    by = got.groupBy("source").agg(F.max("target").alias("t"), F.max("source_size").alias("s"), F.sum("taken").alias("n")).collect()
    assert all(0 <= r["t"] - r["n"] < 1 and r["t"] <= 3 * r["s"] for r in by)
    assert sorted(got.collect()) == sorted(mix_to_weights(many.repartition(7)).collect())
    assert mix_to_weights(none).count() == 0


def test_toxicity(docs, none, spark):
    rows = [(i, f"plain words number {i % 17} about things {i % 5}" + (" moron trash" if i % 4 == 0 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, 1, 1 if i % 4 == 0 else 0) for i in range(0, 400, 3)] + [(None, 1, 1), (5000, None, 1), (8, 0, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()}
    assert all(got[i]["predicted"] == (i % 4 == 0) for i in range(400))
    assert len({r["doc_id"] for r in score_toxicity(docs, labels).collect()}) == 8
    assert score_toxicity(none, labels).count() == 0 and {r["predicted"] for r in score_toxicity(docs, labels.limit(0)).collect()} == {0}


PAGE = "<html><body><nav><ul><li><a href=/>Home page</a></li></ul></nav><article><h1>A &amp; B</h1><p>First  part of the\n story, which is long enough to matter, and <b>more</b>.<p>Second part, also with many words in it.</article><footer>&copy; someone</footer>"


def test_html(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "v", ""), (4, "w", "<<<>& <div><p>x"), (5, "x", "<p>" * 3000 + "deep"), (1, "u", PAGE)]
    got = [r for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    by = {r["page_id"]: r for r in got}
    assert len(got) == 6 and by[1]["text"] == "A & B First part of the story, which is long enough to matter, and more. Second part, also with many words in it."
    assert by[2]["text"] == by[3]["text"] == "" and by[2]["n_chars"] == 0
    assert extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_urls(spark):
    rows = [(1, "http://A.Example.NET/en/x?q#f"), (2, "https://example.net/de/"), (3, None), (4, "no scheme"), (5, "ftp://x.org/fr/a"), (6, "http://Spam-Farm.example.org/en/"), (7, "http://notnet/"), (8, "http://net/"), (9, "http://net"), (10, "x://h?://b/c")]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[2] == ("example.net", "/de/", "net/", "block")
    assert got[3] == got[4] == ("", "", None, "allow") and got[5] == ("x.org", "/fr/a", "org/fr/", "allow")
    assert got[6][2:] == (None, "block") and got[7][2:] == (None, "allow") and got[8][2:] == ("net/", "block") and got[9][2] is None
    assert got[10][:2] == ("h", "")
    long = "http://x.example.net/en/" + "a-b/" * 200_000
    frame = spark.createDataFrame([(1, long, "h", "p"), (1, long, "h", "p"), (2, "HTTP://ADS.x.org/fr/?", None, "")], "page_id long, url string, host string, rule string")
    got = [(r["page_id"], r["rule"], r["verdict"]) for r in filter_urls(frame).collect()]
    assert sorted(got) == [(1, "example.net/en/", "allow")] * 2 + [(2, "org/fr/", "allow")]
    assert filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_chat(spark):
    rows = [(1, 0, "assistant", "hi"), (1, 1, "assistant", "again"), (2, 0, None, None), (None, None, "user", "x"), (3, 1, "user", "b"), (3, 1, "user", "a"), (3, 0, "system", "s")]
    rows += [(9, t // 2, ["user", "assistant", "system", "bot", None][t * 7 % 5], f"t{t % 3}") for t in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    one, many = (sorted(repair_roles(frame, range_rows=n).collect(), key=lambda r: (r["conv_id"] or 0, r["position"])) for n in (10**6, 20))
    assert one == many and len(one) == len(rows)
    for conv in {r[0] for r in rows}:
        text = "".join(r["fragment"] for r in one if r["conv_id"] == conv)
        roles = [p.split("|>")[0] for p in text.split("<|")[1:] if not p.startswith("end")]
        assert roles[-1] == "assistant" and all(a != b for a, b in zip(roles, roles[1:])) and "system" not in roles[1:]
    assert repair_roles(frame.limit(0)).count() == 0


def test_pipeline_judges_rows(spark, tmp_path):
    import corpus_pipeline as cp

    def rows(frame):
        return sorted((r["doc_id"], r["text"]) for r in frame.select(*cp.COLUMNS).collect())

    def frame(pairs):
        return spark.createDataFrame([(d, t, "en", "a", len(t or "")) for d, t in pairs], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)

    # One rare word each: by chance, about half have no cosine above 0 with English.
    clean = [(i, chr(0x0561 + i) * 3 + chr(0x0562 + i)) for i in range(30)] + [(40 + i, "the house and the tree stand by the river") for i in range(20)]
    assert rows(cp.language_id(spark, frame([*clean, (0, "%% 12"), (70, None), (None, "words without an id")]), "")) == sorted(clean)
    copy, other = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    assert rows(cp.minhash_near_dedup(spark, frame([(1, copy), (1, copy), (2, copy), (3, other), (3, other), (3, other)]), "")) == [(1, copy), (3, other)]
    spark.createDataFrame([("i", other)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert rows(cp.benchmark_decontamination(spark, frame([(1, copy), (1, "so " + other), (2, copy)]), str(tmp_path))) == [(1, copy), (2, copy)]


def test_pipeline_on_awkward_rows(spark, tmp_path):
    import random

    import corpus_pipeline as cp

    rng = random.Random(6)
    words = [f"word{k}" for k in range(400)]
    passage = " ".join(rng.choices(words, k=70))
    leak = " ".join(f"leak{k}" for k in range(14))
    rows = [(k, " ".join(rng.choices(words, k=60)), "en", "ab"[k % 2], 1, "x", "y") for k in range(40)]
    rows += [(50, rows[0][1], "en", "a", 1, "x", "y"), (51, rows[3][1], "en", "a", 1, "x", "y"), (51, rows[3][1], "en", "a", 1, "x", "y")]  # copies
    rows += [(k, f"start {k} {' '.join(rng.choices(words, k=30))} {passage} {' '.join(rng.choices(words, k=30))} \ufffd end", "en", None, 1, "x", "y") for k in (60, 61)]
    rows += [(70, f"{' '.join(rng.choices(words, k=30))} {leak}", "en", "a", 1, "x", "y"), (80, None, None, None, None, None, None), (81, "", "en", "a", 0, "", ""), (82, "12 %%", "en", "a", 1, "", ""), (None, "text without an id", "en", "a", 1, "", "")]
    rows += [(5, rows[5][1], "en", "b", 1, "x", "y"), (7, "another text of seven entirely, with words of its own", "en", "b", 1, "x", "y")]  # one doc_id twice
    schema = "doc_id long, text string, lang string, source string, n_chars long, taken string, text_key string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("i", leak), (None, None)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        docs = cp.written(stage(spark, docs, str(tmp_path)), "stage")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = [r.asDict() for r in cp.run(spark, str(tmp_path)).collect()]
    taken = {r["doc_id"]: r["text"] for r in got}
    assert set(before) == {*range(40), 60, 61} and docs.where("doc_id = 5").count() == 1 and docs.where("doc_id = 7").count() == 2
    assert passage in before[60] and passage[60:-60] not in before[61] and before[61].startswith("start 61") and before[61].endswith("\ufffd end")
    assert all(docs.where(F.col("doc_id") == d).where(F.col("text") == t).count() == 1 for d, t in list(taken.items())[:5])
    assert set(taken) <= set(before) and all(0 < r["taken"] <= 3 * r["size"] for r in got) and {"text", "taken", "target"} <= set(got[0])
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert cp.run(spark, f"{tmp_path}/none").count() == 0


def test_every_query_is_registered():
    names = registry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names} >= {f"op{k}" for k in range(1, 14)}
    assert set(registry.oracle_sql()) <= set(names)
