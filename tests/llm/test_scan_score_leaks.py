import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lograft.llm import license_scan, quality, queries, url_filter
from lograft.llm.decontaminate import best_overlap, find_leaks
from lograft.llm.license_scan import PHRASES, TEMPLATES, scan_licenses
from lograft.llm.url_filter import Rule, judge_urls
from tests.conftest import SF001, SF01
from tests.llm import brute


# --- license scan -------------------------------------------------------------

def plain_licenses(text, containment=0.9, step=32):
    w = brute.ALNUM.findall(brute.fold(text))
    places, base = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += at
        if at:
            base.add(label)
    share = {}
    for label, t in TEMPLATES.items():
        words = set(t.split())
        best = max((len(words & set(w[i:i + 2 * step])) for i in range(len(w))), default=0)
        if 1000 * best >= round(containment * 1000) * len(words):
            share[label] = best / len(words)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | set(share))), 1.0 if base else max(share.values(), default=0.0))


def license_texts():
    rng = random.Random(4)
    words = "the of in mit license under gnu public general apache cc by nc 4 0 to any person copy version work is this".split()
    texts = [None, "", "!!! ...", "MIT License", "mit-license; Apache\nLICENSE", "cc by", "CC BY-NC 4.0", "GNU General Public License GNU general public license",
             "the mit licenses", "mİt license", "this wor\u212a is licensed under the gnu general public license version 3", "\u212a", "by cc by cc", *TEMPLATES.values()]
    texts += ["filler " * rng.randint(0, 70) + " ".join(t.split()[rng.randint(0, 2):]) + " tail" * rng.randint(0, 9) for t in TEMPLATES.values() for _ in range(6)]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 200))) for _ in range(120)]
    return texts + ["a " * 40_000 + "Released under the MIT License."]


def test_licenses(docs):
    rows = list(enumerate(license_texts())) + [(None, "mit license"), (3, "MIT License")]
    got = scan_licenses(docs(rows)).collect()
    assert Counter((r[0], *(round(x, 9) if isinstance(x, float) else x for x in r[1:])) for r in map(tuple, got)) == \
        Counter((d, *(round(x, 9) if isinstance(x, float) else x for x in plain_licenses(t))) for d, t in rows)
    assert scan_licenses(docs(rows).limit(0)).collect() == []


def test_license_words_go_by_corpus_frequency(docs):
    rows = [(1, "license license license"), (2, "mit"), (3, "mit license"), (4, "mit")]
    order = license_scan.template_order(docs(rows), {"a": "mit license granted"})
    assert sorted(order, key=order.get) == ["granted", "license", "mit"]


def test_licenses_of_the_tables(spark, sf001):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op5_license_scan(spark, SF001).collect()}
    for r in sf001("documents").collect():
        assert got[r.doc_id] == plain_licenses(r.text)
    assert license_scan.scan_licenses(sf001("documents"))._jdf.queryExecution().executedPlan().toString().count("Python") == 0


def test_license_words_spread_over_a_block_at_any_offset(docs):
    """A notice spread over 53 words or so is found wherever it starts."""
    notice = "permission x is x hereby x x x granted x x x free x x of x x charge x x to x x any x x person x x obtaining x x a x x copy x x of this x x software and associated documentation files"
    got = scan_licenses(docs([(i, "x " * i + notice + " x" * 40) for i in range(34)])).collect()
    assert len(notice.split()) <= 64 and {(r.labels, r.score) for r in got} == {("mit-grant", 1.0)}


# --- quality ------------------------------------------------------------------

def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op7_quality_classifier(spark, SF01).collect()}
    labels = spark.read.parquet(f"{SF01}/labels.parquet").collect()
    test = [(r.quality, rows[r.doc_id]) for r in labels if rows[r.doc_id].held_out]
    assert len(test) > 50 and all(0 <= r.score <= 1 for r in rows.values())
    assert sum((p.predicted == q) for q, p in test) / len(test) > 0.95
    good, bad = ([p.score for q, p in test if q == v] for v in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    kept = ~queries.held_out(F.col("doc_id"))
    other = labels.withColumn("quality", F.when(kept, F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = (quality.fit(docs, x.filter(kept)) for x in (labels, other))
    assert (a.points == b.points).all() and (a.labels == b.labels).all()


def test_quality_edges(docs, spark):
    rows = [(1, "good text here, quite plain " * 5), (2, "BAD!! BAD!! $$$ " * 9), (3, None), (4, ""), (5, "ab"), (None, "good text here"), (2, "BAD!! BAD!! $$$ " * 9),
            (6, "long plain text " * 200_000)]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 0), (99, 1, 0), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    df = docs(rows).withColumn("score", F.lit("clash"))
    model = quality.fit(df, labels)
    assert sorted(model.labels.tolist()) == [0, 0, 1]
    got = quality.score_quality(df, model).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == set(df.columns)
    by = {(r.doc_id, r.text): r.score for r in got}
    prior = pytest.approx(1 / 3)
    assert by[3, None] == by[4, ""] == by[5, "ab"] == prior and by[1, rows[0][1]] > by[2, rows[1][1]]
    assert quality.score_quality(df.limit(0), model).collect() == []
    none = quality.fit(df, labels.limit(0))
    assert {r.score for r in quality.score_quality(df, none).collect()} == {1.0}


def test_the_sample_is_of_labels_with_documents(docs, spark):
    """Labels of a far larger corpus, and an id on many rows, take no other row's place."""
    df = docs([(i, f"text number {i} of the few " * 3) for i in range(5)] + [(2, f"copy {i} of another text") for i in range(40)])
    labels = spark.createDataFrame([(i, int(i != 2)) for i in range(2000)], "doc_id long, quality int")
    assert sorted(quality.fit(df, labels, sample=5).labels.tolist()) == [0, 1, 1, 1, 1]
    assert sorted(quality.fit(df, labels, sample=8).labels.tolist()) == [0, 0, 0, 0, 1, 1, 1, 1]


def test_scores_are_exact_whatever_the_blocks(monkeypatch):
    rng = np.random.default_rng(0)
    shares = np.abs(rng.standard_normal((90, quality.CELLS))).astype(np.float32)
    model = quality.Model(shares[:40], (np.arange(40) % 2).astype(float))
    whole = model.score(shares)
    parts = np.concatenate([model.score(shares[i:i + 7]) for i in range(0, 90, 7)])
    assert np.allclose(whole, parts, atol=1e-5)
    # Brute force over all labelled vectors.
    x = model._unit(model._weighted(shares) @ model.basis)
    for i in (0, 50, 89):
        sims = x[i] @ model.points.T
        best = np.argsort(-sims)[: quality.NEIGHBOURS]
        w = np.maximum(sims[best], 0).astype(float) ** 8 + 1e-9
        assert whole[i] == pytest.approx((w * model.labels[best]).sum() / w.sum(), abs=1e-4)


# --- url filter ---------------------------------------------------------------

def split_url(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
    return brute.fold(m[1]), m[2]


def plain_rule(host, path):
    best = None
    for r in queries.URL_RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.host + r.path) > len(best.host + best.path)):
            best = r
    return best


def plain_standing(pages, trusted, blocked, damping=0.85):
    """Personalised PageRank over all hosts by dense matrices, in units of one restart."""
    edges = Counter()
    for host, html in pages:
        for m in re.findall(r"(?i)href\s*=\s*[\"']?(?:[a-z][a-z0-9+.-]*:)?//([^/\"'?#\s>]+)", html or ""):
            if host and brute.fold(m) != host:
                edges[host, brute.fold(m)] += 1
    hosts = {h for h, _ in pages if h} | {d for _, d in edges}
    up = set()
    for h in hosts:
        parts = h.split(".")
        up |= {(".".join(parts[i:]), ".".join(parts[i + 1:])) for i in range(len(parts) - 2)}
    for low, high in up:
        edges[low, high] += 1
        edges[high, low] += 1
    known = hosts | {h for e in edges for h in e}

    def seeds(names):
        return {h: 1.0 for h in known if any(h == n or h.endswith("." + n) for n in names)}

    names = sorted(known)
    step = np.zeros((len(names), len(names)))
    for (x, y), w in edges.items():
        step[names.index(x), names.index(y)] = w
    step /= np.maximum(step.sum(axis=1, keepdims=True), 1e-12)
    start = [np.array([seeds(s).get(n, 0.0) for n in names]) for s in (trusted, blocked)]
    forward, back = (np.linalg.solve(np.eye(len(names)) - damping * m, x) for m, x in zip((step.T, step), start))
    return Counter(dict(zip(names, forward))), Counter(dict(zip(names, back)))


PAGES = [(1, "http://A.example.NET/x", ""), (2, "https://a.example.net/en/1", ""), (3, "http://b.example.com/de/", None), (4, "http://b.example.com/fr/", ""),
         (5, "https://c.org/fr/1?x", ""), (6, "https://c.org/de/1", ""), (7, None, ""), (8, "nothing here", ""), (9, "http://net", ""), (10, "http://net/", ""),
         (11, "http://spam.info/", '<a href="http://net/buy">x</a> <a HREF=//a.example.net/y>'), (12, "http://fine.info/#a", '<a href="https://c.org/">'),
         (13, "http://fine.info/p://x", '<a href="http://spam.info/">'), (None, "ftp://u:p@Host:21/a?b#c", "<a href='/own'>"), (15, "a://b://c/d", ""),
         (15, "a://b://c/d", ""), (16, "http://xnet/", ""), (17, "://", ""), (18, "http://far.example.info/", '<a href="http://spam.info/">' * 3)]


def test_urls(spark):
    df = spark.createDataFrame([(*p, "clash", "x") for p in PAGES], "page_id long, url string, html string, host string, rule string")
    got = judge_urls(df, queries.URL_RULES).collect()
    trust, distrust = plain_standing([(split_url(u)[0], h) for _, u, h in PAGES], ["example.net", "org"], ["net"])
    want = []
    for page, url, _ in PAGES:
        host, path = split_url(url)
        rule = plain_rule(host, path)
        seed_of = lambda names: any(host == n or host.endswith("." + n) for n in names)
        bad = not seed_of(["example.net", "org"]) and (seed_of(["net"]) or (distrust[host] >= 0.1 and distrust[host] > trust[host]))
        want.append((page, host, path, rule and rule.host + rule.path, rule.verdict if rule else "block" if bad else "allow"))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    verdicts = {w[0]: w[4] for w in want}
    assert [verdicts[p] for p in (11, 13, 18, 6, 4)] == ["block", "block", "block", "allow", "allow"]
    assert judge_urls(df.limit(0), queries.URL_RULES).collect() == []


def test_url_rules_of_the_tables(spark, sf001):
    got = {r.page_id: r for r in queries.op8_url_filter(spark, SF001).collect()}
    for p in sf001("pages").collect():
        host, path = split_url(p.url)
        rule = plain_rule(host, path)
        r = got[p.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.host + rule.path)
        assert rule is None or r.verdict == rule.verdict


def verdicts_of(spark, pages):
    """pages: (host, hosts it links to). Verdicts with ``bad.net`` blocked and ``good.org`` trusted."""
    rows = [(i, f"http://{h}/", "".join(f'<a href="http://{d}/">' for d in to)) for i, (h, to) in enumerate(pages)]
    rules = [Rule("block", "bad.net", "/"), Rule("allow", "good.org", "/en/")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.host: r.verdict for r in judge_urls(df, rules).collect()}


def test_verdicts_of_a_link_farm_whatever_its_size(spark):
    for k in (3, 7, 60):
        farm = [(f"farm{i}.com", ["bad.net"] * (i % 2 + 1)) for i in range(k)]
        fair = [("fair.com", ["bad.net"] + ["fine.com"] * 49), ("fine.com", []), ("good.org", ["known.com"]), ("known.com", ["bad.net", "fine.com"])]
        got = verdicts_of(spark, farm + fair)
        assert {got[h] for h, _ in farm} == {"block"}
        assert {got[h] for h, _ in fair} == {"allow"}


def test_verdicts_far_from_the_blocked_host(spark):
    """0.85 ** 14 is 0.103, 0.85 ** 15 is 0.087."""
    chain = [("hop1.com", ["bad.net"])] + [(f"hop{i}.com", [f"hop{i - 1}.com"]) for i in range(2, 18)]
    got = verdicts_of(spark, chain)
    assert [got[h] for h, _ in chain] == ["block"] * 14 + ["allow"] * 3


def test_a_bad_link_among_many_good_ones(spark):
    """A bad link in 42 or 10, and one two hosts away in 34, block nobody, whoever else is linked to; one in eight does."""
    clean = [(f"clean{i}.com", []) for i in range(41)]
    some = [("one.com", ["bad.net"] + [h for h, _ in clean]), ("ten.com", ["bad.net"] + [h for h, _ in clean[:9]]),
            ("eight.com", ["bad.net"] + [h for h, _ in clean[:7]]), ("far.com", ["farm.com"] + [h for h, _ in clean[:33]]), ("farm.com", ["bad.net"])]
    fans = [(f"fan{i}.com", ["one.com", "clean3.com"]) for i in range(30)]
    got = verdicts_of(spark, clean + some + fans)
    assert {h for h, v in got.items() if v == "block"} == {"eight.com", "farm.com"}


def test_clean_hosts_of_a_random_graph(spark):
    """300 hosts that link to each other, a twentieth of all links to blocked ones, beside 30 that
    link to those alone: of the first nearly none is lost, of the second none is allowed."""
    rng = random.Random(5)
    clean = [f"c{i}.com" for i in range(300)]
    pages = [(h, [rng.choice(clean) if rng.random() > 0.05 else "bad.net" for _ in range(rng.randint(15, 40))]) for h in clean]
    pages += [(f"f{i}.com", ["bad.net", f"f{(i + 1) % 30}.com"]) for i in range(30)]
    got = verdicts_of(spark, pages)
    assert {got[f"f{i}.com"] for i in range(30)} == {"block"}
    rank = plain_standing([(h, "".join(f'<a href="http://{d}/">' for d in to)) for h, to in pages], ["good.org"], ["bad.net"])[1]
    assert all((got[h] == "block") == (rank[h] >= 0.1) for h in clean if abs(rank[h] - 0.1) > 1e-3)


def test_values_are_those_of_endless_rounds(spark):
    """Cycles of hosts, seeds with links among them: both ranks are solutions of their equations."""
    rng = random.Random(8)
    hosts = [f"h{i}" for i in range(12)]
    step = np.zeros((12, 12))
    for i in range(12):
        for j in rng.sample([k for k in range(12) if k != i], 3):
            step[i, j] = rng.randint(1, 5)
    step /= step.sum(axis=1, keepdims=True)
    ways = [w for i in range(12) for j in range(12) if step[i, j]
            for w in (("trust", hosts[j], hosts[i], float(step[i, j])), ("distrust", hosts[i], hosts[j], float(step[i, j])))]
    seeds = [("trust", "h0"), ("trust", "h5"), ("distrust", "h3"), ("distrust", "h5")]
    got = url_filter._spread(spark.createDataFrame(ways, "kind string, host string, via string, share double"),
                             spark.createDataFrame(seeds, "kind string, host string"), 0.85, 1e-4)
    got = {(r.kind, r.host): r.value for r in got.collect()}
    for kind, m in (("trust", step.T), ("distrust", step)):
        start = np.array([float((kind, h) in seeds) for h in hosts])
        want = np.linalg.solve(np.eye(12) - 0.85 * m, start)
        assert np.allclose([got[kind, h] for h in hosts], want, rtol=0, atol=1e-4)


# --- leaks --------------------------------------------------------------------

def plain_leaks(docs, items, least=13):
    """All alignments of every document with every item; all stretches of each, by counting."""
    out = set()
    for d, text in docs:
        w = brute.ALNUM.findall(brute.fold(text))
        for i, item in items:
            t = brute.ALNUM.findall(brute.fold(item))
            need = min(least, len(t))
            for shift in range(-len(t) + 1, len(w)):
                a, b = max(0, -shift), min(len(t), len(w) - shift)
                agree = [w[k + shift] == t[k] for k in range(a, b)]
                if t and len(agree) >= need and 10 * sum(agree) >= 8 * need and any_stretch(agree, need):
                    out.add((d, i))
    return out


def test_leaks_with_substitutions(docs, spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)] + ["the", "of", "and"] * 10
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(15, 45)))) for i in range(12)]
    items += [(50, "short item of eight words is just enough"), (51, "four words as such"), (54, "w7"), (52, None), (53, "")]
    rows, planted = [], set()
    for d in range(150):
        w = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        if d % 3 == 0:
            i, text = items[rng.randrange(13)]
            t = text.split()
            for _ in range(len(t) // 12):
                t[rng.randrange(len(t))] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = t
            planted.add((d, i))
        rows.append((d, rng.choice([" ", "\n", ", "]).join(w).upper()))
    rows += [(500, None), (501, ""), (None, items[0][1]), (502, items[1][1]), (502, "again"), (503, "pad " * 300_000 + items[2][1])]
    bench = spark.createDataFrame([(*x, 1, "c") for x in items], "item_id long, text string, doc_id long, seed string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(docs(rows), bench).collect()}
    want = plain_leaks([r for r in rows if r[0] != 503], items) | {(503, 2)}
    assert got <= want  # every pair found is one
    assert planted - {p for p in planted if p not in want} <= got  # every planted one is found
    assert {(None, 0), (502, 1), (503, 2)} <= got
    # What is missed has no seed in common: fewer than one in a hundred here.
    assert len(want - got) <= len(want) // 100
    assert find_leaks(docs(rows).limit(0), bench).collect() == [] == find_leaks(docs(rows), bench.limit(0)).collect()


def test_leak_spans(docs, spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    text = "before it " + item.replace("seven", "7th") + " after"
    r = find_leaks(docs([(5, text), (6, item[:30])]), bench).collect()
    assert [tuple(x) for x in r] == [(5, 1, 13, 14, 2, 0)]


def test_leaks_of_the_tables(spark, sf001):
    got = {(r.doc_id, r.item_id) for r in queries.op10_decontamination(spark, SF001).collect()}
    items = [(r.item_id, " ".join(brute.ALNUM.findall(brute.fold(r.text)))) for r in sf001("benchmark").collect()]
    for d in sf001("documents").collect():
        text = " " + " ".join(brute.ALNUM.findall(brute.fold(d.text))) + " "
        for i, item in items:
            if f" {item} " in text:
                assert (d.doc_id, i) in got


def any_stretch(agree, need, share=0.8):
    """Whether ``need`` words in a row or more have the share, by counting in all of them."""
    n = len(agree)
    return any(10 * sum(agree[s:e]) >= round(10 * share) * (e - s) for s in range(n) for e in range(s + need, n + 1))


def test_longer_stretches_than_the_one_with_most_agreement():
    rng = random.Random(3)
    for n in (13, 14, 15, 19, 24, 31):
        for _ in range(300):
            agree = np.array([rng.random() < rng.choice((0.7, 0.8, 0.9)) for _ in range(n)])
            s, e = best_overlap(agree, 0.8)
            assert (e - s >= 13 and 10 * agree[s:e].sum() >= 8 * (e - s)) == any_stretch(agree.tolist(), 13)


def test_leaks_with_a_changed_word_anywhere(docs, spark):
    """(12 of 13, 13 of 15, 15 of 16 words agree; each was lost.)"""
    items, rows = [], []
    for i, (n, changed) in enumerate([(13, (10,)), (15, (2, 12)), (20, (3, 16))]):
        w = [f"i{i}w{k}" for k in range(n)]
        items.append((i, " ".join(w)))
        rows.append((i, "some words before " + " ".join("changed" if k in changed else x for k, x in enumerate(w)) + " and after it"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, find_leaks(docs(rows), bench).collect())) == [(0, 0, 12, 13, 3, 0), (1, 1, 13, 15, 3, 0), (2, 2, 15, 16, 7, 4)]


def test_leaks_of_short_items(docs, spark):
    """Copies of items of 1 to 12 words, and of 5 to 12 words with any one word changed."""
    items, rows, want = [], [], set()
    for n in range(1, 13):
        w = [f"n{n}w{k}" for k in range(n)]
        items.append((n, " ".join(w)))
        for j in range(-1, n):
            d = 100 * n + j + 1
            rows.append((d, "before it " + " ".join("changed" if k == j else x for k, x in enumerate(w)) + " and after"))
            if j < 0 or n >= 5:
                want.add((d, n, n - (j >= 0), n, 2, 0))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in find_leaks(docs(rows), bench).collect()}
    assert got == want


def test_an_overlap_far_longer_than_its_hits_is_whole(docs, spark):
    """200 words of which only the first 20 stand in a row: every fourth other one is changed."""
    w = [f"w{k}" for k in range(200)]
    text = "before " + " ".join("changed" if k > 20 and k % 5 == 0 else x for k, x in enumerate(w))
    bench = spark.createDataFrame([(1, " ".join(w))], "item_id long, text string")
    agree = sum(not (k > 20 and k % 5 == 0) for k in range(200))
    assert [tuple(r) for r in find_leaks(docs([(5, text)]), bench).collect()] == [(5, 1, agree, 200, 1, 0)]
