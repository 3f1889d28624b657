import random
import re
from collections import defaultdict

from clickstream.llm.url_filter import UNIT, judge, keep_allowed, propagate, rule_table

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
         ("net/fr/", "block"), ("bad.org/", "block"), ("good.org/", "allow")]
HREF = re.compile(r"""\b(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'<>\s]+)""", re.I)


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest).group()
    return lower(host), re.match(r"[^?#]*", rest[len(host):]).group()


def rule_of(host, path, rules):
    fits = [(len(r), r, v) for r, v in rules
            if (host == r[:r.index("/")] or host.endswith("." + r[:r.index("/")])) and host and path.startswith(r[r.index("/"):])]
    return max(fits)[1:] if fits else (None, None)


def walk(seeds, flow, rounds, damping=85):
    score = dict(seeds)
    for _ in range(rounds):
        got = defaultdict(int)
        for s, to in flow.items():
            for d in to:
                got[d] += score.get(s, 0) // len(to)
        score = {h: ((100 - damping) * seeds[h] + damping * got[h]) // 100 for h in seeds}
    return score


def brute(rows, rules, rounds=10):
    """(url, html) rows -> (host, path, rule, verdict, trust, distrust) in plain Python."""
    cut = [split(u) for u, _ in rows]
    ruled = [rule_of(h, p, rules) for h, p in cut]
    pages, ok, no = defaultdict(int), defaultdict(int), defaultdict(int)
    for (h, _), (_, v) in zip(cut, ruled):
        if h:
            pages[h] += 1
            ok[h] += v == "allow"
            no[h] += v == "block"
    out, back = defaultdict(set), defaultdict(set)
    edges = set()
    for (h, _), (_, html) in zip(cut, rows):
        for t in HREF.findall(html or "") if h else []:
            edges.add((h, lower(re.sub(r":\d*$", "", t.split("@")[-1]))))
    for h in pages:
        up = h
        while "." in up:
            up = up[up.index(".") + 1:]
            if up in pages:
                edges |= {(h, up), (up, h)}
                break
    for a, b in edges:
        if a != b and b in pages:
            out[a].add(b)
            back[b].add(a)
    good = {h: n if 2 * ok[h] > n else 0 for h, n in pages.items()}
    bad = {h: n if 2 * no[h] > n else 0 for h, n in pages.items()}
    share = lambda s: {h: n * (UNIT // max(1, sum(s.values()))) for h, n in s.items()}
    trust, distrust = walk(share(good), out, rounds), walk(share(bad), back, rounds)
    res = []
    for (h, p), (r, v) in zip(cut, ruled):
        t, d = trust.get(h, 0), distrust.get(h, 0)
        res.append((h, p, r, v or ("block" if 100 * d > 50 * (t + d) else "allow"), t, d))
    return res


def make(seed):
    rnd = random.Random(seed)
    hosts = ["example.com", "www.example.com", "a.example.com", "x.net", "es.x.net", "bad.org", "sub.bad.org", "good.org",
             "blog.good.org", "near-bad.io", "near-good.io", "lone.io", "both.io", "com", "net"]
    rows = []
    for _ in range(150):
        h = rnd.choice(hosts + ["x.net"] * 8)
        to = {"near-bad.io": ["bad.org", "Sub.BAD.org:80"], "good.org": ["near-good.io", "both.io"], "both.io": ["bad.org"]}.get(h, [rnd.choice(hosts)])
        html = "<p>" + " ".join(f'<a {rnd.choice(["href", "HREF", "src"])} = "{rnd.choice(["http://", "//", "https://u@"])}{t}/x?y">' for t in to)
        path = rnd.choice(["", "/", "/a", "/b/", "/en/1", "/es/2", "/fr/", "/en", "?q=/en/", "#/es/"])
        url = rnd.choice(["http://", "HTTPS://", "x y\nftp://"]) + (h.upper() if rnd.random() < .2 else h) + path
        rows.append((url, rnd.choice([html, html, None, "<a href='/local'>"])))
    return rows + [(None, None), ("no scheme.com/en/", "<a href='http://bad.org'>"), ("://", None), ("a://b://c/d", ""), ("", None)] + rows[:5]


def rows_of(df):
    return sorted((tuple(r.judged) for r in df.collect()), key=str)


def test_matches_plain_version(llm):
    by_method = set()
    for seed in range(3):
        rows = make(seed)
        want = brute(rows, RULES)
        by_method |= {v for *_, r, v, _, _ in want if r is None}
        df = llm.createDataFrame([(u, h, "clash", "clash", 1) for u, h in rows], "url string, html string, host string, row string, own int")
        got = judge(df, rule_table(llm, RULES))
        assert got.columns == [*df.columns, "judged"]
        assert rows_of(got) == sorted(want, key=str)
        assert sorted(str(r.url) for r in keep_allowed(df, rule_table(llm, RULES)).collect()) == sorted(
            str(u) for (u, _), w in zip(rows, want) if w[3] == "allow")
    assert by_method == {"allow", "block"}


def test_links_decide(llm):
    rows = [("http://bad.org/", None)] * 3 + [("http://near-bad.io/", "<a href=//bad.org>"), ("http://lone.io/", None),
                                              ("http://good.org/", '<a href="https://near-good.io/">'), ("http://near-good.io/", None)]
    df = llm.createDataFrame(rows, "url string, html string")
    got = {r.host: r.verdict for r in judge(df, rule_table(llm, RULES)).select("judged.*").collect()}
    assert got == {"bad.org": "block", "near-bad.io": "block", "lone.io": "allow", "good.org": "allow", "near-good.io": "allow"}


def test_empty_tables_and_null_rules(llm):
    df = llm.createDataFrame([("http://a.com/", None)], "url string, html string")
    none = llm.createDataFrame([(None, "block"), ("a.com/", None)], "rule string, verdict string")
    assert [r.verdict for r in judge(df, none).select("judged.*").collect()] == ["allow"]
    assert [r.verdict for r in judge(df, none.where("false")).select("judged.*").collect()] == ["allow"]
    assert judge(df.where("false"), rule_table(llm, RULES)).count() == 0


def test_long_text_and_hot_host(llm):
    html = "<a href='http://bad.org'>" * 20_000 + "x" * 500_000
    rows = [("http://hot.io/%d" % i, html if i == 0 else None) for i in range(300)] + [("http://bad.org/", None)]
    got = judge(llm.createDataFrame(rows, "url string, html string"), rule_table(llm, RULES)).select("judged.*")
    assert got.where("host = 'hot.io' and verdict = 'block'").count() == 300


def test_scores_do_not_depend_on_rounds_written(llm):
    rnd = random.Random(4)
    hosts = [f"h{i}" for i in range(30)]
    seeds = llm.createDataFrame([(h, i % 5 and 0 or i + 1, i % 7 and 0 or 2) for i, h in enumerate(hosts)], "host string, trusted long, blocked long")
    edges = llm.createDataFrame(list({(rnd.choice(hosts), rnd.choice(hosts)) for _ in range(90)}), "src string, dst string").where("src <> dst")
    got = [sorted(map(tuple, propagate(seeds, edges, rounds=6, write_every=w).collect())) for w in (2, 6)]
    assert got[0] == got[1] and sum(r[1] > 0 for r in got[0]) > 6
