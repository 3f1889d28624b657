import math
import random
from collections import defaultdict

from pyspark.sql import functions as F

from clickstream.llm import quality_classifier as C
from clickstream.llm.common import held_out


def make(seed=0, n=900):
    rnd = random.Random(seed)
    docs, labels, sites, truth = [], [], [], {}
    for i in range(n):
        host = rnd.choice(["hot"] * 5 + [f"h{k}" for k in range(15)])
        path = rnd.choice(["a", "b", None])
        bad_site = host in ("h1", "h2", "h3") or (host == "hot" and path == "b")
        good = rnd.random() > (0.8 if bad_site else 0.15)
        words = [rnd.choice(["stone", "river", "tree", "cloud", "hill"]) + str(rnd.randint(0, 30)) for _ in range(rnd.randint(5, 60))]
        if not good and rnd.random() < 0.7:
            words = [w + "###" for w in words]
        docs.append((i, " ".join(words)))
        truth[i] = good
        if i % 2:
            labels.append((i, int(good)))
        sites.append((i, host if i % 11 else None, path))
    return docs, labels, sites, truth


def frames(spark, docs, labels, sites):
    return (spark.createDataFrame([(*d, 0.5, "h") for d in docs], "doc_id long, text string, score double, host string"),
            spark.createDataFrame(labels, "doc_id long, quality int"),
            spark.createDataFrame(sites, "doc_id long, host string, path string"))


def brute_rates(rows, soft=0.25):
    """Host and path rates by plain loops over (host, path, label or None, z)."""
    sums = defaultdict(lambda: [0.0, 0.0])
    for h, p, y, z in rows:
        n = soft if y is None else 1.0
        g = n * (1 / (1 + math.exp(-z)) if y is None else y)
        sums[h, p][0] += n
        sums[h, p][1] += g
    n, g = sum(v[0] for v in sums.values()), sum(v[1] for v in sums.values())
    rate = (g + 0.5) / (n + 1)

    def strength(groups):
        if len(groups) < 2:
            return 1e4
        n = sum(x[0] for x in groups)
        ss = sum(a * (b / a - c) ** 2 for a, b, c in groups)
        within = sum(c * (1 - c) for _, _, c in groups)
        spread = (ss - within) / max(n - sum(a * a for a, _, _ in groups) / n, 1e-9)
        return min(1e4, max(1.0, within / len(groups) / max(spread, 1e-9) - 1))

    hosts = defaultdict(lambda: [0.0, 0.0])
    for (h, _), (a, b) in sums.items():
        if h is not None:
            hosts[h][0] += a
            hosts[h][1] += b
    k_host = strength([(a, b, rate) for a, b in hosts.values()])
    host = {h: (b + k_host * rate) / (a + k_host) for h, (a, b) in hosts.items()}
    below = {(h, p): v for (h, p), v in sums.items() if h is not None and p is not None}
    k_path = strength([(a, b, host[h]) for (h, _), (a, b) in below.items()])

    def of(row):
        """(host rate, path rate) of a row by all other rows."""
        h, p, y, z = row
        own_n = soft if y is None else 1.0
        own_g = own_n * (1 / (1 + math.exp(-z)) if y is None else y)
        hr = (g - own_g + 0.5) / (n - own_n + 1)
        if h is not None:
            hr = (hosts[h][1] - own_g + k_host * hr) / (hosts[h][0] - own_n + k_host)
        pr = (below[h, p][1] - own_g + k_path * hr) / (below[h, p][0] - own_n + k_path) if (h, p) in below else hr
        return hr, pr

    return of


def test_rates_match_brute_force_and_held_out_accuracy(llm):
    docs, labels, sites, truth = make()
    d, l, s = frames(llm, docs, labels, sites)
    use = ~held_out(F.col("doc_id"))
    got = {r.doc_id: r for r in C.classify(d, l, s, usable=use).collect()}
    held = {r.doc_id for r in d.where(held_out(F.col("doc_id"))).collect()}
    lab = {i: float(y) for i, y in labels if i not in held}
    base = math.log((sum(lab.values()) + 1) / (len(lab) - sum(lab.values()) + 1))
    at = {i: (h, p if h is not None else None) for i, h, p in sites}
    rows = {i: (*at[i], lab.get(i), got[i].evidence + base) for i, _ in docs}
    rates = brute_rates(list(rows.values()))
    for i, _ in docs:
        hr, pr = rates(rows[i])
        assert math.isclose(got[i].host_rate, hr, abs_tol=1e-6)
        assert math.isclose(got[i].path_rate, pr, abs_tol=1e-6)
        z = got[i].evidence + math.log(got[i].path_rate / (1 - got[i].path_rate))
        assert math.isclose(got[i].score, 1 / (1 + math.exp(-z)), abs_tol=1e-6)
    right = sum((got[i].score >= 0.5) == truth[i] for i in held)
    alone = sum((got[i].evidence + base >= 0) == truth[i] for i in held)
    assert right >= 0.85 * len(held) and right >= alone


def test_sparse_sites_shrink(llm):
    docs, labels, sites, _ = make(1, 300)
    i = 10_001
    docs.append((i, docs[0][1]))
    labels.append((i, 0))
    sites.append((i, "new", "x"))
    got = {r.doc_id: r for r in C.classify(*frames(llm, docs, labels, sites)).collect()}
    assert 0.2 < got[i].host_rate < 0.95  # one bad page does not make a bad host


def test_own_label_does_not_count_for_itself(llm):
    docs, labels, sites, _ = make(2, 300)
    for i in (10_001, 10_002):  # the same text, alone on its site, once good and once bad
        docs.append((i, docs[0][1]))
        labels.append((i, i % 2))
        sites.append((i, f"alone{i}", "x"))
    got = {r.doc_id: r for r in C.classify(*frames(llm, docs, labels, sites)).collect()}
    a, b = got[10_001], got[10_002]
    assert abs(a.path_rate - b.path_rate) < 0.01 and a.path_rate <= b.path_rate  # only the rest of the corpus differs


def test_odd_rows_and_empty_tables(llm):
    docs = [(1, None), (1, ""), (2, "a b c"), (None, "x"), (3, "word " * 100_000)]
    labels = [(1, 1), (1, 0), (2, None), (None, 1), (3, 0)]
    sites = [(1, "h", "p"), (1, "g", "q"), (2, None, "p"), (3, "g", None)]
    d, l, s = frames(llm, docs, labels, sites)
    out = C.classify(d, l, s).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert len(C.classify(d, l.where("false"), s.where("false")).collect()) == 5
    assert C.classify(d.where("false"), l, s).count() == 0


def test_page_sites(llm):
    urls = ["http://a.example.net/fr/25930", "https://b.c.org/en/7198#top", "https://x.y/es/12?page=2", "http://x.y/", None, "junk"]
    got = C.page_sites(llm.createDataFrame([(u,) for u in urls], "url string")).collect()
    assert [tuple(r) for r in got] == [(25930, "a.example.net", "fr"), (7198, "b.c.org", "en"), (12, "x.y", "es")]
