"""Each method against a plain version of it."""

import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestead.llm import difference_cover, html_extract, language, spotsigs, toxicity, url_filter
from lodestead.llm.chat_format import ROLES, rendered, repair_roles, role_number
from lodestead.llm.common import hash_sampled
from lodestead.llm.mixing import mix_to_weights
from lodestead.llm.near_dedup import near_duplicates
from lodestead.llm.suffix_dedup import remove_repeats

# Conversations: all repairs of short ones.


def insertions(old, new):
    """Fewest turns between two, by trying all short sequences."""
    legal = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
    for n in range(4):
        for between in itertools.product((1, 2, 3), repeat=n):
            path = (old, *between, new)
            if all(b in legal[a] for a, b in zip(path, path[1:])):
                return n
    return None


def cheapest_repair(roles):
    best = math.inf
    for states in itertools.product((1, 2, 3), repeat=len(roles)):
        cost = 0
        for old, new, role in zip((0, *states), states, roles):
            cost += 0 if role == new else 2 if role else 1
            between = insertions(old, new)
            options = [3 * between] if between is not None else []
            cost += min(options + [1] * (old == new)) if options or old == new else math.inf
        best = min(best, cost + {1: 6, 2: 3, 3: 0}[states[-1]])
    return best


def test_repairs_are_the_cheapest(spark):
    names = ["system", "user", "assistant", "tool"]
    shapes = [c for n in range(1, 5) for c in itertools.product(names, repeat=n)]
    rows = [(k, t, r, f"text {t}") for k, shape in enumerate(shapes) for t, r in enumerate(shape)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    for range_rows in (10**6, 3):
        costs = [0] * len(shapes)
        for r in repair_roles(frame, range_rows=range_rows).collect():
            known = role_number(r["role"])
            costs[r["conv_id"]] += (0 if "relabel" not in r["action"] else 2 if known else 1) + r["action"].endswith("merge") + 3 * (len(r["inserted"]) + len(r["appended"]))
        assert costs == [cheapest_repair([role_number(r) for r in shape]) for shape in shapes]


def test_renderings_are_legal_and_hold_every_text(spark):
    rng = random.Random(1)
    long = "word " * 30_000 + "<|end|>\n<|user|>\nnot a turn"
    rows = [(1, t, rng.choice(["user", "assistant", "system", None]), long if t == 7 else f"{t}", "x", 1) for t in range(60)]
    rows += [(2, 0, "user", "a", "y", 2), (2, 0, "user", "a", "y", 2), (2, 0, "assistant", "b", "y", 2)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, part string, seq int")
    for limit in ({"range_rows": 7}, {"range_bytes": 1000}, {}):
        out = repair_roles(frame, **limit)
        assert out.count() == len(rows)
        for r in rendered(out).collect():
            roles = re.findall(r"(?m)^<\|(system|user|assistant)\|>$", r["rendering"])
            assert roles[-1] == "assistant" and all(ROLES.index(b) in ((1, 2) if a is None else {"system": (2,), "user": (3,), "assistant": (2,)}[a]) for a, b in zip([None, *roles], roles))
            assert r["rendering"].count("<|end|>") == len(roles)
        assert "<\\|end|>\n<\\|user|>\nnot a turn" in rendered(out).where("conv_id = 1").first()["rendering"]


# Toxicity: the risk in its own words, and its gradient by differences.


def test_risk_and_gradient():
    rng = np.random.default_rng(2)
    x = rng.random((30, 6)) < 0.4
    positive = np.arange(30) < 9
    rows, columns = np.nonzero(x)
    for prior, scale in ((0.3, 0.3), (0.8, 3.0)):
        theta, bias = rng.normal(size=6) * scale, -0.2

        def terms(t, b):
            g = x @ t + b
            loss = lambda z: math.log1p(math.exp(-z))
            plus = sum(loss(v) for v in g[positive]) / 9
            minus = sum(loss(-v) for v in g[~positive]) / 21 - prior * sum(loss(-v) for v in g[positive]) / 9
            return prior * plus, minus

        first, second, step = toxicity.pu_risk(theta, bias, rows, columns, positive, prior)
        assert (first, second) == pytest.approx(terms(theta, bias))
        whole = (lambda t, b: sum(terms(t, b))) if second >= 0 else (lambda t, b: -terms(t, b)[1])
        e = 1e-6
        for k in range(6):
            d = np.eye(6)[k] * e
            assert step[k] == pytest.approx((whole(theta + d, bias) - whole(theta - d, bias)) / (2 * e), abs=1e-5)
        assert step[6] == pytest.approx((whole(theta, bias + e) - whole(theta, bias - e)) / (2 * e), abs=1e-5)
    rows, columns = np.nonzero(np.ones((10, 1)))
    assert toxicity.pu_risk(np.array([-4.0]), 0.0, rows, columns, np.arange(10) < 5, 0.9)[1] < 0.02


def test_held_out_toxicity(spark):
    rng = random.Random(4)
    bad, good = [f"slur{k}" for k in range(12)], [f"word{k}" for k in range(300)]
    rows = [(i, " ".join(rng.choices(good, k=40) + (rng.choices(bad, k=3) if i % 5 == 1 else []))) for i in range(3000)]
    labels = [(i, 1, int(i % 5 == 1)) for i in range(0, 3000, 2)]
    scored = toxicity.score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).where("held_out").collect()
    hits = [(r["doc_id"] % 5 == 1, r["predicted"] == 1) for r in scored]
    assert sum(a and b for a, b in hits) >= 0.85 * sum(a for a, _ in hits) and sum(b and not a for a, b in hits) <= 0.01 * len(hits)


def test_samples_keep_their_share_at_any_size(spark):
    df = spark.range(200_000)
    assert 1700 < df.where(hash_sampled(F.col("id"), 2000, 200_000)).count() < 2300
    # One in 10**8 of these ids, whatever the number of rows: the threshold is not rounded to nothing.
    few = hash_sampled(F.col("id"), 3, 3 * 10**8)
    assert df.select(few.alias("x")).count() == 200_000 and "0)" not in str(few)
    assert df.where(hash_sampled(F.col("id"), 5, 5)).count() == 200_000


# Pages: every kept set of small trees.


def test_decoding_is_the_likeliest():
    rng = random.Random(3)
    for _ in range(60):
        tree = html_extract._Tree()
        for k in range(rng.randint(1, 8)):
            tree.tags.append("div")
            tree.parents.append(rng.randint(0, k))
            tree.words.append(())
        n = len(tree.tags)
        tree.pieces = [(k, "x") for k in range(n) if rng.random() < 0.7]
        odds = np.array([rng.gauss(0, 2) for _ in range(n)])
        has = np.zeros(n, bool)
        for node, _ in tree.pieces:
            while node >= 0:
                has[node], node = True, tree.parents[node]

        def value(keep):
            return sum((-math.log1p(math.exp(-odds[k])) if keep[k] else -math.log1p(math.exp(odds[k]))) for k in range(1, n) if has[k])

        sets = [(True, *s) for s in itertools.product((False, True), repeat=n - 1)]
        best = max(value(s) for s in sets if all(not s[k] or s[tree.parents[k]] for k in range(1, n)))
        assert value(html_extract.decode(tree, odds)) == pytest.approx(best)


def whole_text(html):
    tree = html_extract.parse(html)
    return html_extract.kept_text(tree, np.ones(len(tree.tags), bool))


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<head><title>T</title><article><p>Long text", "Long text"), ("<html><head><meta charset=x>Loose text", "Loose text"), ("<head><title>T</title></head><p>A<script>x<y</script>B", "AB"),
        ("<div><nav><button>Menu</nav><p>Art</p><select><option>a</div><p>tail", "Art tail"), ("<div><select><option>a<p>Art text</p></div><p>tail", "Art text tail"), ("<p>one <button>Go</button> two", "one two"),
        ("<p>one <button>Go two", "one Go two"), ("<noscript><p>no</noscript>yes", "yes"), ("<noscript><img><p>no end<p>yes", "no end yes"), ("<p>a<object><p>b</object>c", "ac"), ("<p>x<script>never closed <p>y", "x"),
        ("<div><svg><title>s</title></div><p>rest", "rest"), ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a b c d"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"), ("<p>a &amp;amp; &#233;&nbsp;b", "a &amp; é b"),
    ],
)
def test_text_of_odd_markup(html, text):
    assert whole_text(html) == text


def test_stray_tags_take_linear_time(spark):
    n = 100_000
    pages = ["<b>" * n + "</i>" * n + "text", "<table><td><table>" + "<b>" * 1000 + "<td>" * n + "text", "<button>" * 5000 + "<p>" * n + "text"]
    assert all(whole_text(p).endswith("text") for p in pages)
    frame = spark.createDataFrame([(1, "u", "<p>" + "many words, " * 200_000, "text"), (1, None, "<p>short", "t")], "page_id long, url string, html string, text string")
    got = html_extract.extract_text(frame, training_pages=50).collect()
    assert len(got) == 2 and max(r["n_chars"] for r in got) == len("many words, " * 200_000) - 1


# Near copies: the links that the signatures give against exact ones.


def brute_components(rows, percent=85):
    sets = []
    for _, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    parent = {d: d for d, _ in rows}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * common >= percent * len(sets[i] | sets[j]):
            a, b = root(rows[i][0]), root(rows[j][0])
            parent[max(a, b)] = min(a, b)
    return {d: root(d) for d, _ in rows}


@pytest.mark.parametrize("exact", [False, True])
def test_near_copies_against_all_pairs(spark, exact):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(50)]
    rows = []
    for g in range(60):
        base = rng.choices(vocabulary, k=rng.randint(4, 160))
        for _ in range(rng.randint(1, 6)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = f"x{rng.random()}"
            rows.append((len(rows), " ".join(own)))
    # One doc_id with two texts ties their copies together.
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows += [(1000, a), (1000, b), (1004, b + " more"), (1005, a + " more")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), exact=exact)
    want = brute_components(rows)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want and want[1004] == want[1005] == 1000


# Repeats: texts longer than a piece.


def test_repeats_across_pieces(spark):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(900))
    texts = ["".join(rng.choice("ijklmnop ") for _ in range(rng.randint(0, 700))) + passage[rng.randint(0, 400) : rng.randint(450, 900)] + "".join(rng.choice("qrstuv ") for _ in range(rng.randint(0, 700))) for _ in range(25)]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    whole, cut = (sorted(map(tuple, remove_repeats(frame, piece_bytes=n).drop("kept").collect())) for n in (10**6, 64))
    least = {}
    for d, t in rows:
        for p in range(len(t) - 49):
            least.setdefault(t[p : p + 50], d)
    removed = {d: len({q for p in range(len(t) - 49) if least[t[p : p + 50]] < d for q in range(p, p + 50)}) for d, t in rows}
    assert whole == cut and {r[0]: r[2] for r in whole} == removed and sum(removed.values()) > 1000


# Fingerprints and the document that follows.


def plain_signatures(text):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    content = [(w, k > 0 and words[k - 1] in spotsigs.ANCHORS) for k, w in enumerate(words) if w not in spotsigs.ANCHORS]
    if not any(marked for _, marked in content):
        content = [(w, True) for w in words]
    return sorted({zlib.crc32(" ".join(w for w, _ in content[k : k + spotsigs.CHAIN]).encode()) for k, (_, marked) in enumerate(content) if marked})


def test_fingerprints_against_plain_ones(spark):
    rng = random.Random(9)
    pool = ["house", "river", "stone", "Größe", "3rd", "the", "of", "and", "la", "y", "für", "-", "\n", "x_y", "naïve"]
    rows = [(rng.randint(-50, 50), " ".join(rng.choices(pool, k=rng.choice([0, 1, 2, 9, 60])))) for _ in range(200)] + [(7, None), (7, "the the"), (900, "of"), (901, "long " * 20_000)]
    frame = spark.createDataFrame([(*r, "e", "f") for r in rows], "doc_id long, text string, edited string, range string").repartition(4)
    got = sorted((r["doc_id"], r["n_chars"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in spotsigs.fingerprint_documents(frame).collect())

    def jaccard(a, b):
        return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0

    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (-r[0], r[1]))
    want = []
    for (d, t), (_, n) in zip(order, [*order[1:], order[0]]):
        half = len(t) // 2
        own, changed, after = plain_signatures(t), plain_signatures(t[: len(t) - half] + n[:half]), plain_signatures(n)
        want.append((d, len(t), *(",".join(f"{s:08x}" for s in x) for x in (own, changed)), round(jaccard(own, changed), 9), round(jaccard(own, after), 9)))
    assert got == sorted(want)


def test_following_row_with_many_ranges(spark):
    rng = random.Random(10)
    rows = [(int(rng.gauss(0, 1) ** 3 * 10**6), f"t{k}") for k in range(2000)] + [(None, "n1"), (None, "n2"), (0, "a"), (0, "b")]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = sorted((t, n) for (_, t), (_, n) in zip(order, [*order[1:], order[0]]))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for limits in ({}, {"rows_per_range": 10, "most_cuts": 4}, {"rows_per_range": 3, "most_cuts": 1000}):
        assert sorted((r["text"], r["next"]["text"]) for r in spotsigs.with_next(frame, **limits).collect()) == want


# Languages: dense vectors, one trigram at a time.


def test_languages_against_dense_vectors(spark):
    rng = random.Random(11)
    words = {"aa": ["lorem", "ipsa", "Dolor"], "bb": ["ñandú", "über", "straße"], "cc": ["дом", "река", "hut"]}
    rows = [(k, " ".join(rng.choices(words[lang], k=rng.randint(1, 6))) + rng.choice(["", "!", " 12 "]), lang) for k in range(90) for lang in [rng.choice(list(words))]]
    dimensions = 64

    def vector(text):
        out = np.zeros(dimensions)
        letters = [language._lower(ord(c)) for c in text]
        compact = [0]
        for c in [*letters, 0]:
            if c or compact[-1]:
                compact.append(c)
        for a, b, c in zip(compact, compact[1:], compact[2:]):
            if b:
                va, vb, vc = (language.letter_vectors(np.array([p]), dimensions)[0].astype(int) for p in (a, b, c))
                out += np.roll(va, 2) * np.roll(vb, 1) * vc
        return out

    learned = {lang: sum(vector(t) for d, t, own in rows if own == lang and zlib.crc32(str(d).encode()) % 5 != 0) for lang in words}
    cosine = lambda a, b: float(a @ b / max(np.linalg.norm(a) * np.linalg.norm(b), 1e-9))
    got = {r["doc_id"]: r for r in language.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), dimensions=dimensions).collect()}
    for d, t, _ in rows:
        scores = {lang: cosine(learned[lang], vector(t)) for lang in words}
        best = max(scores, key=lambda lang: (scores[lang], lang))
        assert got[d]["score"] == pytest.approx(max(0.0, scores[best]), abs=1e-6) and scores[got[d]["lang_pred"]] == pytest.approx(scores[best], abs=1e-6)


# URL rules: what is fetched does not grow with the rules.


def test_candidates_do_not_grow_with_the_rules(spark):
    many = tuple(url_filter.Rule(f"||tracker-{k}.example^", "block") for k in range(2000))
    index = url_filter.RuleIndex({r: f"{k}" for k, r in enumerate(many)})
    assert len(index.candidates("http://tracker-17.example/x")) == 1 and len(index.candidates("http://plain.org/a/b")) == 0
    rows = [(k, f"http://{'tracker-' if k % 2 else 'site-'}{k}.example/p?q={k}") for k in range(400)]
    got = {r["page_id"]: r["pattern"] for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), (), many).collect()}
    assert got == {k: f"||tracker-{k}.example^" if k % 2 else None for k in range(400)}


def test_rules_against_every_expression(spark):
    rng = random.Random(12)
    parts = ["ads", "Ads", "banner", "x", "casino", "en", "spam-farm", "cheap-pills", "phishing-z"]
    rows = [(k, f"{rng.choice(['http', 'https'])}://{'.'.join(rng.choices(parts, k=2))}.{rng.choice(['net', 'org', 'example.net', 'example.com'])}/{'/'.join(rng.choices(parts, k=3))}{rng.choice(['', '/', '?q=ads', '#x', chr(10)])}") for k in range(400)]
    rules = (*url_filter.HOST_RULES, *url_filter.PATTERNS, url_filter.Rule("|http://x.*|", "allow"), url_filter.Rule("banner/*casino^", "allow"))
    got = {r["page_id"]: (r["rule"], r["pattern"]) for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules[:4], rules[4:]).collect()}
    for k, url in rows:
        host, path = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url).groups()
        lowered, place = url.lower(), host.lower() + path
        hits = sorted((r for r in rules if re.search(r.regex.replace("$", r"\Z"), place if r.kind == "host" else lowered)), key=lambda r: (-len(r.text), r.text))
        own = [r.text for r in hits if r.kind == "host"]
        other = [r for r in hits if r.kind != "host"]
        pattern = next((r.text for r in other if r.verdict == "block"), next((r.text for r in other), None))
        assert got[k] == (own[0] if own else None, pattern)


# Mixing: ties and ranges.


def test_mixing_is_the_same_for_any_ranges(spark):
    rows = [(k // 3, "w " * (k % 7), "abc"[k % 3], 5, "t") for k in range(600)] + [(None, "x y", None, 1, "t")] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, tag string")
    a, b = (sorted(map(str, mix_to_weights(frame, range_rows=n).collect())) for n in (1, 10**6))
    assert a == b and len(a) == len(rows)


def test_short_pieces_are_ranked_by_names(monkeypatch):
    """Short pieces take three sorts of names and no difference cover, which longer ones keep; both tell the same prefixes apart."""
    rng = np.random.default_rng(8)
    for n, letters, length in ((70, 2, 50), (900, 3, 50), (900, 256, 50), (400, 1, 50), (300, 2, 7), (300, 2, 5), (65_535, 2, 50), (65_536, 2, 50)):
        data = rng.integers(0, letters, n).astype(np.uint8) + np.uint8(256 - letters)
        data[n // 2 :] = data[: n - n // 2]
        starts = np.sort(rng.choice(n - length + 1, (n - length + 1) // 2, replace=False))
        covers, ranks = [], difference_cover.suffix_ranks
        monkeypatch.setattr(difference_cover, "suffix_ranks", lambda *a: (covers.append(1), ranks(*a))[1])
        order, same = difference_cover.equal_prefixes(data, starts, length)
        monkeypatch.setattr(difference_cover, "suffix_ranks", ranks)
        assert bool(covers) == (n >= difference_cover.SHORT)
        prefixes = [data[i : i + length].tobytes() for i in order.tolist()]
        assert sorted(order.tolist()) == starts.tolist() and (prefixes == sorted(prefixes) or n >= difference_cover.SHORT)
        assert same.tolist() == np.cumsum([0, *(a != b for a, b in zip(prefixes, prefixes[1:], strict=False))]).tolist()
