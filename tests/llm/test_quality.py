import random
import re
from collections import Counter
from fractions import Fraction

from maskcorpus.llm import quality as Q


def slow_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def slow_class(v):
    drop = max(v.bit_length() - 5, 0)
    return v >> drop << drop


def slow_kept(rows):
    """kept of rows (lang, source, text), by plain sorting."""
    stats = [slow_stats(t) for _, _, t in rows]
    failed = [s[0] < 20 or 100 * s[4] > 30 * s[0] for s in stats]
    values = [s[0] and [s[1] * 1000 // s[0], s[2] * 1000 // s[0], s[3] * 1000 // s[0], s[4] * 1000 // s[0]] for s in stats]
    spread = [500, 50, 20, 75]

    def quartile(shares, k, quarter):
        """Smallest class at which the weights of ``shares`` (group, documents it counts as) reach that share of all."""
        weights = Counter()
        for group, documents in shares:
            for i in group:
                weights[slow_class(values[i][k])] += Fraction(documents, len(group))
        upto = 0
        for at in sorted(weights):
            upto += weights[at]
            if 4 * upto >= quarter * sum(weights.values()):
                return at

    def fences(own, lang, every):
        out = []
        for k in range(4):
            shares = [(own, len(own)), (lang, 50), (every, 50)]
            q1, q3 = quartile(shares, k, 1), quartile(shares, k, 3)
            reach = 4 * max(q3 - q1, spread[k])
            out.append((q1 - reach if k == 0 else -1, q3 + reach))
        return out

    good = [i for i in range(len(rows)) if not failed[i]]
    found = {g: fences([j for j in good if rows[j][:2] == g], [j for j in good if rows[j][0] == g[0]], good) for g in {rows[i][:2] for i in good}}
    kept = [not failed[i] and all(lo <= v <= hi for (lo, hi), v in zip(found[rows[i][:2]], values[i])) for i in range(len(rows))]
    return stats, failed, kept


def corpus():
    rng = random.Random(3)
    vocab = ["".join(rng.choices("abcdefgé", k=rng.randint(2, 9))) for _ in range(300)]

    def prose(n):
        return "\n".join(" ".join(rng.choices(vocab, k=12)) for _ in range(n // 12 + 1))

    rows = []
    for i in range(420):
        t = prose(rng.randint(20, 300))
        rows.append((rng.choice(["en", "en", "de", None]), rng.choice(["a", "a", "b", None]), t))
    rows += [("en", "a", " ".join(w + "%%%" for w in prose(80).split())) for _ in range(12)]
    rows += [("de", "b", "x y " * 40), ("en", "a", None), ("en", "a", ""), ("en", "a", " \n\t"), ("en", "a", prose(9000)),
             ("en", "a", "same line here\n" * 3 + prose(200)), ("en", "a", prose(60) + "\n" + prose(24) * 2),
             ("xx", "q", " ".join("w" * 90 for _ in range(3)) + prose(30)), ("en", "a", "\x0b".join(vocab[:60])),
             ("en", "a", " ".join(vocab[:8])), ("en", "a", " ".join(vocab[:9])), ("de", "a", "z " * 9),
             ("en", "b", "q" * 60000 + " " + prose(40)), ("en", "a", " ".join(["w" * 60] * 1 + ["u%d" % i * 9 for i in range(40)]))]
    rows += rows[:3]
    return rows


def test_judge_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, l, s, "x") for i, (l, s, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, source string, n_words string")
    got = {r.doc_id: r for r in Q.judge(df).collect()}
    stats, failed, kept = slow_kept(rows)
    assert len(got) == len(rows)
    for i in range(len(rows)):
        assert tuple(got[i][c] for c in Q.STATS) == stats[i], rows[i]
        assert (got[i].base_failed, got[i].kept) == (failed[i], kept[i]), (i, stats[i])
    assert 0 < sum(kept) < len(kept) - sum(failed)
    out = Q.keep_good(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [i for i in range(len(rows)) if kept[i]]


def test_sketches_merge(spark):
    df = spark.createDataFrame([("a", v) for v in (0, 1, 31, 32, 33, 34, 1000)] + [("b", 33)], "g string, v long")
    got = df.select(Q.value_class(df.v).alias("c")).collect()
    assert [r.c for r in got] == [0, 1, 31, 32, 32, 34, 992, 32]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert Q.judge(df).collect() == [] and Q.keep_good(df).collect() == []


def test_every_group_has_thresholds_of_its_own(spark):
    """Groups of 5, 60 and 400 documents whose words have different lengths: each fence lies nearer its own, the more documents."""
    rng = random.Random(7)

    def text(n, size):
        return " ".join("".join(rng.choices("abcdef", k=rng.randint(size, size + 2))) for _ in range(n))

    rows = [("en", s, text(40, size)) for s, size, n in (("few", 9, 5), ("some", 9, 60), ("many", 9, 400), ("base", 3, 600)) for _ in range(n)]
    df = spark.createDataFrame([(i, t, g, s) for i, (g, s, t) in enumerate(rows)], "doc_id long, text string, lang string, source string")
    got = {r.source: r for r in Q.thresholds(Q.with_stats(df)).collect()}
    assert set(got) == {"few", "some", "many", "base"}
    assert got["base"].word_length_max < got["many"].word_length_min  # many documents: near its own
    assert got["few"].word_length_min < got["base"].word_length_min < got["many"].word_length_min  # few: wide, near its parents
    assert len({tuple(r[2:]) for r in got.values()}) >= 3


def test_repeat_fence_is_the_base_rules(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = Q.thresholds(Q.with_stats(docs)).collect()
    assert len(got) > 50 and all(r.repeat_rate_max >= 10 * Q.MAX_REPEAT_PERCENT for r in got)
