"""Hard negatives, url verdicts and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import hardneg, hostgraph, resample

EXTRA = "row long, part int, rank string, host string, known long, v string, ok int, score string"


def clash(df):
    """Extra columns named like the operators' own."""
    for name, kind in (c.split(" ") for c in EXTRA.split(", ")):
        df = df.withColumn(name, F.lit("7").cast(kind))
    return df


# --- hard negatives ---------------------------------------------------------


def negatives_by_hand(rows, positives=5, negatives=10, low=30, high=90, scale=256):
    def fit(r):
        return None not in r and all(x is not None and math.isfinite(x) for x in r[1])

    rows = [(i, [math.floor(x * scale) for x in v], lab) for i, v, lab in filter(fit, rows)]
    out = []
    for i, v, lab in rows:
        if i % 100:
            continue
        s = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in rows if j != i]
        for p, j, _ in sorted(x for x in s if x[2] == lab)[:positives]:
            ok = sorted((n, k) for n, k, other in s if other != lab and low * -p <= 100 * -n <= high * -p)
            out += [(i, j, r, k, -p, -n) for r, (n, k) in enumerate(ok[:negatives], 1)]
    return sorted(out)


def vectors(n, dims=6, labels=4, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    return [(int(i * 20), [float(x) for x in centres[i % labels] + rng.normal(size=dims)], int(i % labels)) for i in range(n)]


@pytest.mark.parametrize("group, block", [(1 << 15, 512), (8, 4)])
def test_hard_negatives_match_brute_force(spark, group, block):
    rows = vectors(400)
    rows += [(100, rows[3][1], 1), (100, rows[3][1], 1), (7, rows[5][1], 2), (7, rows[5][1], 2)]  # repeated rows
    rows += [(9000 + i, rows[0][1], 3) for i in range(120)]  # one vector many times: ties by id
    rows += [(200, None, 1), (300, [1.0, None], 1), (400, [float("nan")] * 6, 1), (500, [0.1] * 6, None), (None, [0.1] * 6, 1)]
    rows += [(600, [float("inf")] * 6, 1), (700, [0.0] * 6, 1), (800, [0.5], 1), (900, [], 2), (1100, [1.0] * 6, 77)]
    df = clash(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5))
    got = sorted(map(tuple, hardneg.mine(df, group=group, block=block).collect()))
    assert got == negatives_by_hand(rows)


def test_hard_negatives_of_large_components(spark):
    rows = [(i, [x * 3e5 for x in v], lab) for i, v, lab in vectors(60)]  # products beyond 2**53
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, hardneg.mine(df).collect())) == negatives_by_hand(rows)
    with pytest.raises(ValueError):
        hardneg.mine(df.withColumn("embedding", F.transform("embedding", lambda x: x * 1e6)))


def test_hard_negatives_of_empty_tables(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hardneg.mine(df).count() == 0
    assert hardneg.mine(spark.createDataFrame([(5, [1.0], 1)], df.schema)).count() == 0  # no anchor
    assert hardneg.mine(spark.createDataFrame([(0, [1.0], 1), (5, [2.0], 2)], df.schema)).count() == 0  # no positive


def test_spanning_tree_is_minimal():
    points = np.random.default_rng(2).normal(size=(40, 3))
    order, parent, edge = hardneg.spanning_tree(points)
    assert sorted(order) == list(range(40)) and all(parent[k] < k for k in range(40))
    gap = np.linalg.norm(points[:, None] - points[None], axis=2)
    assert np.allclose(edge[1:], [gap[order[k], order[parent[k]]] for k in range(1, 40)])
    group = list(range(40))  # Kruskal
    total = 0.0
    for d, a, b in sorted((gap[a, b], a, b) for a in range(40) for b in range(a)):
        if group[a] != group[b]:
            total, old = total + d, group[a]
            group = [group[b] if g == old else g for g in group]
    assert edge.sum() == pytest.approx(total)


def test_the_tree_spares_scores_and_loses_none():
    rng = np.random.default_rng(4)
    v = np.floor(rng.normal(size=(30, 8)) * 20 + 400 * (np.arange(30) % 3)[:, None])
    c = np.floor(rng.normal(size=(500, 8)) * 20)
    order, parent, edge = hardneg.spanning_tree(v)
    tree = hardneg.Tree(order, order, np.zeros(30, np.int64), v[order], parent, edge)
    low, high = np.full(30, 2000.0), np.full(30, 9000.0)
    found = {(k, i) for k, at, _ in hardneg.walk(tree, c, False, np.ones(500, np.int64), low, high) for i in at.tolist()}
    score = v[order] @ c.T
    assert found == {(int(k), int(i)) for k, i in zip(*np.nonzero((score >= 2000) & (score <= 9000)))}


# --- url verdicts -----------------------------------------------------------


def link(*hosts):
    return " ".join(f'<a class="x" href="https://{h}/p">t</a>' for h in hosts)


PAGES = [
    (1, "http://a.example.net/en/1?x=http://q", "<a href='/local'>x</a>"),
    (2, "https://a.example.net/fr/1", None),
    (3, "HTTP://B.Example.COM/de/", link("c.example.com")),
    (4, "http://c.example.com/en/", link("bad.example.com", "bad.example.com")),
    (5, "http://bad.example.com/de/1#/en/", ""),
    (6, "http://bad.example.com/x", link("elsewhere.test")),
    (7, "http://www.x.org/fr/2", link("Friend.TEST:80")),
    (8, "http://x.org/de/2", link("c.example.com")),
    (9, "http://friend.test:80", link("bad.example.com")),
    (10, "http://friend.test:80?a/net/", '<a HREF = //bad.example.com/q>'),
    (11, None, link("bad.example.com")),
    (12, "no scheme", link("bad.example.com")),
    (13, "://net/", None),
    (14, "http://internet/", None),
    (15, "http://net", None),
    (16, "", ""),
    (None, None, None),
    (5, "http://bad.example.com/de/1#/en/", ""),
    (17, "http://sub.bad.example.com/en/" + "long/" * 20000, link(*["h%d.test" % i for i in range(3000)])),
]


def verdicts_by_hand(pages):
    fixed = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    low = str.maketrans(hostgraph.UPPER, hostgraph.LOWER)
    rows, edges, count = [], set(), {}
    for i, url, html in pages:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest).group().translate(low)
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        fit = [r for r in fixed if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fit, key=lambda r: len(r[1] + r[2]), default=None)
        rows.append((i, host, path, best[1] + best[2] if best else None, best[0] if best else None))
        if host:
            n = count.setdefault(host, [0, 0, 0])
            n[0] += 1
            if best:
                n[1 if best[0] == "allow" else 2] += 1
            edges |= {(host, h.translate(low)) for h in re.findall(r"//([^\s/?#\"'<>]+)", html or "") if h.translate(low) != host}
    start = [{h: 10**7 * n[k] // n[0] * 15 // 100 for h, n in count.items()} for k in (1, 2)]
    steps = [edges, {(b, a) for a, b in edges}]
    ends = []
    for ranks0, step in zip(start, steps):
        degree, ranks = {}, ranks0
        for a, _ in step:
            degree[a] = degree.get(a, 0) + 1
        for _ in range(hostgraph.ROUNDS):
            new = dict(ranks0)
            for a, b in step:
                new[b] = new.get(b, 0) + 85 * ranks.get(a, 0) // (100 * degree[a])
            ranks = new
        ends.append(ranks)
    trust, distrust = ends
    out = []
    for i, host, path, rule, verdict in rows:
        t, d = trust.get(host, 0), distrust.get(host, 0)
        out.append((i, host, path, rule, verdict or ("block" if d >= hostgraph.THRESHOLD and d > t else "allow"), t, d))
    return out


def key(row):
    return [(x is not None, x if x is not None else 0) for x in row]


def test_verdicts_match_brute_force_and_sql(spark):
    schema = "page_id long, url string, html string"
    df = clash(spark.createDataFrame(PAGES, schema).repartition(3))
    got = sorted(map(tuple, hostgraph.judge(df).collect()), key=key)
    want = sorted(verdicts_by_hand(PAGES), key=key)
    assert got == want
    told = {r[0]: r[4] for r in got}
    assert told[3] == "block" and {r[0]: r[6] for r in got}[4] > 0  # blocked by rule; a host that links to a blocked one
    known = {r[0]: r for r in got}[6]  # a host half trusted friends link to: trust outweighs
    assert known[6] >= hostgraph.THRESHOLD and known[5] > known[6] and told[6] == "allow"
    assert told[8] == "allow" and told[12] == "allow" and told[14] == "allow"
    con = duckdb.connect()
    con.register("pages", pa.table({n: [r[k] for r in PAGES] for k, n in enumerate(("page_id", "url", "html"))}))
    assert sorted(con.sql(hostgraph.oracle("pages")).fetchall(), key=key) == want
    assert hostgraph.judge(spark.createDataFrame([], schema)).count() == 0


def test_a_hub_that_links_everywhere(spark):
    rows = [(i, f"http://h{i}.test/", link("hub.test")) for i in range(300)]
    rows += [(1000, "http://hub.test/", link(*[f"h{i}.test" for i in range(300)], "spam.example.com"))]
    rows += [(1001 + i, "http://spam.example.com/de/", "") for i in range(300)]  # a hot host
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = sorted(map(tuple, hostgraph.judge(df).collect()), key=key)
    assert got == sorted(verdicts_by_hand(rows), key=key)
    assert {r[0]: r[4] for r in got}[1000] == "block"


# --- importance resampling --------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def resampled_by_hand(docs, target, percent=5, least=20, buckets=10000, seed=42):
    low = str.maketrans(hostgraph.UPPER, hostgraph.LOWER)

    def found(t):
        w = WORD.findall((t or "").translate(low))
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    s, t = [0] * buckets, [0] * buckets
    each = [(i, *found(x)) for i, x in docs]
    for _, _, f in each:
        for b in f:
            s[b] += 1
    for x in target:
        for b in found(x)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, n, f in each:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        rows.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[4] = k
    return [tuple(r) for r in rows]


def corpus():
    rng = random.Random(9)
    vocab = ["Alpha", "beta", "Straße", "naïve", "日本語", "x1", "42", "Ümlaut", "q" * 300, "don't", "e-mail", "ÄÖ"]
    texts = [None, "", " \x00\n", "one", "Two words", "A\x00B", "a.b,c", "İstanbul K", "w" * 200_000]
    texts += [" ".join(rng.choice(vocab) for _ in range(rng.randrange(5, 60))) for _ in range(150)]
    texts += ["the same copied text of " + "more words " * 12] * 60
    texts.append(" ".join(rng.choice(vocab) for _ in range(40_000)))
    docs = list(enumerate(texts)) + [(None, texts[20]), (None, texts[20]), (None, None), (20, texts[20]), (20, texts[20]), (21, texts[30])]
    return docs, [texts[12], "beta 42 x1 " * 30, None, ""]


@pytest.mark.parametrize("percent", [5, 60, 100, 0])
def test_resampling_matches_brute_force(spark, percent):
    docs, target = corpus()
    df = clash(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    goal = clash(spark.createDataFrame([(x,) for x in target], "text string"))
    got = [tuple(r) for r in resample.resample(df, goal, percent=percent).collect()]
    want = resampled_by_hand(docs, target, percent)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    docs, _ = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert resample.resample(none, df).count() == 0
    got = sorted((tuple(r) for r in resample.resample(df, none).collect()), key=key)
    assert got == sorted(resampled_by_hand(docs, []), key=key)


def test_appending_to_a_crc():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 7, 64, 255, 1000, 70_001):
        head, tail = rng.randbytes(50), rng.randbytes(n)
        moved = resample._moved(resample._append(n)[None], np.array([zlib.crc32(head)], dtype=np.uint32))
        assert int(moved[0]) ^ zlib.crc32(tail) == zlib.crc32(head + tail)


def test_slices_of_words_lose_no_run(spark, monkeypatch):
    texts = pa.array(["a b c d e", None, "f", "g h i j"])
    want = sorted((int(d), int(b)) for doc, b_ in resample.Runs(texts).features(10_000) for d, b in zip(doc, b_))
    monkeypatch.setattr(resample, "SLICE", 2)
    got = sorted((int(d), int(b)) for doc, b_ in resample.Runs(texts).features(10_000) for d, b in zip(doc, b_))
    assert got == want and len(want) == (5 + 4 + 3) + 1 + (4 + 3 + 2)
