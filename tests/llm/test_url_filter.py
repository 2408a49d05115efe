import math
import random
import re
from collections import defaultdict

from maskcorpus.llm import url_filter as U
from maskcorpus.llm.queries import RULES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_for(host, path):
    best = None
    for says, text in RULES:
        name, _, rest = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(text) > len(best[1])):
            best = says, text
    return best or (None, None)


def slow(pages, labels):
    label = {}
    for i, b in labels:
        if i is not None and b is not None:
            label[i] = max(b, label.get(i, 0))
    count = defaultdict(lambda: [0, 0])
    for i, url in pages:
        c = count[parts(url)]
        if i in label:
            c[0] += 1
            c[1] += label[i]
    state = {}
    for host, path in count:
        segments = [re.sub("[0-9]+", "*", s) for s in path.split("/") if s]
        if len(segments) > U.MAX_DEPTH:
            segments = segments[:U.MAX_DEPTH] + ["**"]
        state[host, path] = (host, len(segments), ""), segments
    for level in range(U.MAX_DEPTH + 1):
        branch = defaultdict(lambda: defaultdict(lambda: [0, 0]))
        for key, (node, segments) in state.items():
            if len(segments) > level:
                b = branch[node][segments[level]]
                b[0] += count[key][0]
                b[1] += count[key][1]
        for key, (node, segments) in state.items():
            if len(segments) > level:
                own, k = branch[node][segments[level]], len(branch[node])
                n, b = own
                an, ab = (sum(v[j] for v in branch[node].values()) for j in (0, 1))
                p, q, r = (b + .5) / (n + 1), (ab - b + .5) / (an - n + 1), (ab + .5) / (an + 1)
                keep = k == 1 or n >= U.MIN_LABELS and abs(p - q) > U.Z * math.sqrt(r * (1 - r) * (1 / (n + 1) + 1 / (an - n + 1)))
                state[key] = (node[0], node[1], node[2] + "/" + (segments[level] if keep else "*")), segments
    template = {key: node[0] + (node[2] or "/") for key, (node, _) in state.items()}
    total = defaultdict(lambda: [0, 0])
    for key, t in template.items():
        total[t][0] += count[key][0]
        total[t][1] += count[key][1]
    labelled, bad = (sum(c[j] for c in count.values()) for j in (0, 1))
    prior = bad / labelled if labelled else 0
    out = []
    for i, url in pages:
        host, path = parts(url)
        t = template[host, path]
        purity = (total[t][1] + U.SMOOTHING * prior) / (total[t][0] + U.SMOOTHING)
        says, rule = rule_for(host, path)
        out.append((i, host, path, rule, says or ("block" if purity >= U.REJECT else "allow"), t, round(purity, 12)))
    return out


def run(spark, pages, labels):
    df = spark.createDataFrame([(i, u, "x") for i, u in pages], "page_id long, url string, host string")
    lab = spark.createDataFrame(labels, "page_id long, bad int")
    return [(*tuple(r)[:6], round(r.purity, 12)) for r in U.judge(df, lab, RULES, max_depth=U.MAX_DEPTH).collect()]


def test_against_brute_force(spark):
    rng = random.Random(11)
    pages, labels = [], []
    for i in range(1500):
        host = rng.choice(["a.example.org"] * 5 + ["b.example.org", "www.example.com", "shop.example.net", "Q.EXAMPLE.org", "x.com"])
        section = rng.choice(["en", "fr", "spam", "blog", "news", "rare%d" % rng.randint(0, 99), "es"])
        url = f"http{rng.choice(['', 's'])}://{host}/{section}/{rng.choice(['', 'p/', 'q/r/'])}{rng.randint(1, 900)}{rng.choice(['', '.html', '/', '?a=/b', '#x'])}"
        pages.append((i, url))
        if rng.random() < 0.5:
            labels.append((i, int(rng.random() < (0.95 if section == "spam" else 0.1))))
    odd = [None, "", "no scheme/at/all", "://", "http://", "http://HOST", "http://h?q", "http://h#f/en/", "x://a/b://c/d", "http://example.com/en/x",
           "http://www.example.com/en/", "http://example.com/EN/", "http://net/es/1", "http://anet/es/1", "http://com", "http://com/", "http://é.ORG/É/\n?x",
           "http://deep.example.org/" + "/".join("s%d" % i for i in range(12)), "http://deep.example.org//a//b//", "http://long/" + "y" * 50000]
    pages += [(5000 + i, u) for i, u in enumerate(odd)] + [(None, odd[3]), (1, pages[1][1]), (1, pages[1][1])]
    labels += [(None, 1), (3, None), (labels[0][0], 1), (labels[0][0], 0)]
    got, want = run(spark, pages, labels), slow(pages, labels)
    assert sorted(got, key=str) == sorted(want, key=str)
    spam = [r for r in got if r[5] == "a.example.org/spam/*"]
    assert spam and all(r[4] == "block" for r in spam) and any(r[5].startswith("a.example.org/*") and r[4] == "allow" for r in got)
    assert {r[3] for r in got} == {None, "com/", "example.com/en/", "www.example.com/en/", "net/es/", "net/fr/"}


def test_without_labels_or_pages(spark):
    assert run(spark, [], []) == []
    assert run(spark, [(1, "http://a.org/x")], []) == [(1, "a.org", "/x", None, "allow", "a.org/x", 0.0)]


def test_query_sees_every_level(spark, tmp_dir, monkeypatch):
    from maskcorpus.llm.queries import op8_url_filters
    rng = random.Random(5)
    pages, labels = [], []
    for i in range(900):
        top = "/".join("l%s" % c for c in "abcdefg")
        branch = rng.choice(["good", "bad", "fine", "also"])
        tail = rng.choice(["", "/x/y%d" % rng.randint(0, 3), "/" + "/".join(rng.choice("pq") for _ in range(rng.randint(1, 5)))])
        pages.append((i, f"http://deep.example.edu/{top}/{branch}{tail}/{rng.randint(1, 300)}"))
        labels.append((i, 0 if branch == "bad" else 1, 0))
    pages.append((5000, "http://long.example.edu/" + "/".join("c%s" % chr(97 + k % 26) for k in range(30))))
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_dir}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    with monkeypatch.context() as deep:
        deep.setattr(U, "MAX_DEPTH", 40)  # of the brute force: deeper than any of these paths
        want = slow(pages, [(i, 1 - q) for i, q, _ in labels])
    got = [(*tuple(r)[:6], round(r.purity, 12)) for r in op8_url_filters(spark, tmp_dir).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    verdicts = {(r[2].split("/")[8], r[4]) for r in got if r[0] < 5000}
    assert verdicts == {("good", "allow"), ("fine", "allow"), ("also", "allow"), ("bad", "block")}
    assert not any("**" in r[5] for r in got)


def test_a_long_chain_is_one_round(spark, monkeypatch):
    rounds = []
    stage = U.staged
    monkeypatch.setattr(U, "staged", lambda df, name: rounds.append(name) or stage(df, name))
    chain = "/".join("s%s" % chr(97 + k % 26) for k in range(200))
    paths = spark.createDataFrame([("h", f"/{chain}/{end}", 1, 0, 0) for end in ("x", "y")], "host string, path string, pages long, labelled long, bad long")
    assert {r.template for r in U.templates(paths).collect()} == {f"h/{chain}/*"}
    assert rounds.count("branches") == 2
