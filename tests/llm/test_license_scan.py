import random

from maskcorpus.llm import license_scan as L


def slow_increasing(pairs):
    best = [1] * len(pairs)
    for k in range(len(pairs)):
        for m in range(k):
            if pairs[m][1] < pairs[k][1]:
                best[k] = max(best[k], best[m] + 1)
    return max(best, default=0)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def test_longest_increasing():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(0, 14)
        pairs = list(enumerate(rng.sample(range(30), n)))
        got = L._increasing(pairs)
        assert len(got) == slow_increasing(pairs) and all(p[1] < q[1] for p, q in zip(got, got[1:])) and set(got) <= set(pairs)


def test_patience_is_an_alignment_and_near_the_longest():
    rng = random.Random(2)
    total = best = 0
    for _ in range(200):
        a = ["w%d" % rng.randint(0, 60) for _ in range(rng.randint(0, 60))]
        b = [w for w in a if rng.random() < 0.8] + ["x"] * rng.randint(0, 3)
        for _ in range(rng.randint(0, 5)):
            b.insert(rng.randrange(len(b) + 1), "w%d" % rng.randint(0, 60))
        got = L.patience(a, b)
        assert all(a[i] == b[j] for i, j in got) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
        total, best = total + len(got), best + lcs(a, b)
        assert len(got) <= lcs(a, b)
    assert total > 0.9 * best
    assert L.patience([], ["a"]) == [] and L.patience(["a"], ["a"]) == [(0, 0)]


def filler(rng, n):
    return [" ".join(rng.choice(["der", "la", "the", "is", "under", "work", "license", "of", "q%d" % rng.randint(0, 500)]) for _ in range(n))][0]


def test_every_template_is_found_whole_and_damaged():
    rng = random.Random(3)
    scanner = L.Scanner(L.TEMPLATES)
    for name, text in L.TEMPLATES.items():
        words = L.words_of(text)
        for _ in range(8):
            copy = list(words)
            # a notice without the words that tell it from its neighbours is none
            plain = [i for i, w in enumerate(words) if w not in scanner.telling[name]]
            for _ in range(int(len(words) * 0.1)):
                copy[rng.choice(plain)] = "changed"
            before = rng.randint(0, 900)
            page = L.words_of(filler(rng, before)) + copy + L.words_of(filler(rng, rng.randint(0, 900)))
            # words of the filler before a short notice may make it the longer notice of the same license
            found = [f for f in scanner.scan(page) if before - 20 <= f.start <= before + len(copy)]
            assert any(f.license == name.removesuffix("-name") or f.license == name for f in found) or any(f.end - f.start > len(words) for f in found), name


def test_clean_text_has_none_and_repeats_have_all():
    rng = random.Random(4)
    scanner = L.Scanner(L.TEMPLATES)
    assert all(scanner.scan(L.words_of(filler(rng, 400))) == [] for _ in range(50))
    line = "Licensed under the Apache License, Version 2.0.\n"
    assert [f.license for f in scanner.scan(L.words_of(line * 3))] == ["Apache-2.0"] * 3
    assert [f.license for f in scanner.scan(L.words_of("x y. Released under the MIT License. All rights reserved. z"))] == ["MIT-notice", "all-rights-reserved"]


def test_stretches_lose_nothing_against_whole_alignment():
    """A window is found wherever aligning the template with the right place of the text reaches the coverage."""
    rng = random.Random(6)
    scanner = L.Scanner(L.TEMPLATES)
    for name, words in scanner.words.items():
        for before in (0, 1, len(words) // 2, 3 * len(words) + 1):
            text = ["der"] * before + words + ["die"] * rng.randint(0, 3 * len(words))
            best = max((len(L.patience(text[a:b], words)) for a, b in scanner.stretches(text, name)), default=0)
            assert best == len(words), (name, before)


def test_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Foo İ\nReleased under the MIT License.", "x"), (3, "Foo İ\nReleased under the MIT License.", "x"),
            (None, "All rights reserved.", "x"), (4, "word " * 100000 + L.TEMPLATES["MIT"], "x"), (5, "licensed under licensed under", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = sorted((str(r.doc_id), r.license, r.coverage, r.n_notices, r.licenses) for r in L.summary(df).collect())
    assert got == [("1", None, None, 0, ""), ("2", None, None, 0, ""), ("3", "MIT-notice", 1.0, 1, "MIT-notice"), ("3", "MIT-notice", 1.0, 1, "MIT-notice"),
                   ("4", "MIT", 1.0, 1, "MIT"), ("5", None, None, 0, ""), ("None", "all-rights-reserved", 1.0, 1, "all-rights-reserved")]
    spans = {r.doc_id: r.notices for r in L.scan(df).collect()}
    assert rows[2][1][spans[3][0].start:spans[3][0].end] == "Released under the MIT License"
    assert L.summary(df.limit(0)).collect() == []


def test_documents_against_plain_search(spark):
    lines = {"Apache-2.0": "Licensed under the Apache License, Version 2.0.", "MIT-notice": "Released under the MIT License.",
             "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
             "all-rights-reserved": "All rights reserved."}
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = {r.doc_id: r.licenses for r in L.summary(docs).collect()}
    seen = 0
    for r in docs.collect():
        want = sorted((at, name) for name, line in lines.items() for at in range(len(r.text)) if r.text.startswith(line, at)) if any(
            x in r.text for x in lines.values()) else []
        assert got[r.doc_id] == ",".join(n for _, n in want), r.doc_id
        seen += bool(want)
    assert seen > 30 and len(got) == 10000


def names(text):
    return [f.license for f in L.Scanner(L.TEMPLATES).scan(L.words_of(text))]


def test_neighbours_get_their_own_names():
    for text, want in (
            ("Licensed under CC BY 4.0", ["CC-BY-4.0-short"]), ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
            ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ["CC-BY-NC-4.0-notice"]),
            ("This work is licensed under the GNU General Public License, version 2", ["GPL-2.0"]),
            ("It is under the GNU General Public License, version 2", ["GPL-2.0-name"]),
            ("GNU Lesser General Public License, version 3", ["LGPL-3.0-name"]), ("Released under the BSD License", ["BSD-notice"]),
            ("all human rights are reserved", []), ("All rights reserved", ["all-rights-reserved"]),
            ("Released under the Eclipse License", []), ("Released under the MIT License", ["MIT-notice"]),
            ("Licensed under the Apache License, Version 1.1", []), ("Licensed under CC BY 3.0", []),
            ("This work is licensed under the GNU Library General Public License, version 3", [])):
        assert names(text) == want, text


def test_no_template_is_taken_for_another():
    for name, text in L.TEMPLATES.items():
        assert names(f"some words before {text} and behind") == [name], name
        doubled = names(f"{text}. A few words between the two. {text}")
        assert doubled == [name, name], name
    pairs = [(a, b) for a in L.TEMPLATES for b in L.TEMPLATES]
    for a, b in pairs:
        assert names(f"{L.TEMPLATES[a]}\n\nx y z u v w and something else that is said here\n\n{L.TEMPLATES[b]}") == [a, b], (a, b)


def test_interleaved_copies_are_whole_at_every_offset():
    """Other words between a notice's own up to twice its length: full coverage and the whole span, wherever it begins."""
    scanner = L.Scanner(L.TEMPLATES)
    for name in ("Apache-2.0-header", "ISC", "BSD-2-Clause", "GPL-3.0-header"):
        words = scanner.words[name]
        for share in (1.0, 1.5, 1.6, 1.8, 1.95):
            copy, more = [], 0.0
            for w in words:
                copy.append(w)
                more += share - 1
                while more >= 1 and len(copy) < share * len(words) - 1:
                    copy.append("zzz")
                    more -= 1
            while copy[-1] == "zzz":
                copy.pop()
            for before in range(0, len(words), 3):
                found = scanner.scan(["der"] * before + copy + ["die"] * 40)
                assert [(f.license, f.coverage, f.start, f.end) for f in found] == [(name, 1.0, before, before + len(copy))], (name, share, before)


def slow_scan(text, scanner):
    """Every start and every width up to twice a template's length, no windows, for texts with at most one notice."""
    best = None
    for name, words in scanner.words.items():
        for a in range(len(text)):
            for b in range(a + scanner.need[name], min(len(text), a + 2 * len(words)) + 1):
                if text[a] in scanner.counts[name] and text[b - 1] in scanner.counts[name]:
                    pairs = L.patience(text[a:b], words)
                    if scanner.holds(name, text[a:b], pairs):
                        key = (-len(pairs), -len(pairs) / len(words), name)
                        best = min(best, key) if best else key
    return best


def test_scan_against_every_start_and_width():
    rng = random.Random(12)
    short = {k: v for k, v in L.TEMPLATES.items() if len(L.words_of(v)) < 16}
    scanner = L.Scanner(short)
    hits = 0
    for _ in range(120):
        copy = list(scanner.words[rng.choice(list(short))])
        for _ in range(rng.choice([0, 0, 1, 2])):
            copy.insert(rng.randrange(len(copy) + 1), rng.choice(["zzz", "mit", "2", "the", "license"]))
        if rng.random() < 0.4:
            copy[rng.randrange(len(copy))] = rng.choice(["zzz", "3", "bsd", "nc"])
        text = L.words_of(filler(rng, rng.randint(0, 8))) + copy + L.words_of(filler(rng, rng.randint(0, 8)))
        want = slow_scan(text, scanner)
        got = min(((-round(f.coverage * len(scanner.words[f.license])), -f.coverage, f.license) for f in scanner.scan(text)), default=None)
        assert (got is None) == (want is None) and (want is None or got[0] <= want[0] + 1), (text, got, want)
        hits += want is not None
    assert hits > 50
