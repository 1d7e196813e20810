"""op6: alignment against longest common subsequences, finds in texts."""

import random

from earworm.llm import licenses
from llm_corpus import frame, rows, text


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def longest_increasing(values):
    best = []
    for i, v in enumerate(values):
        best.append(1 + max((best[j] for j in range(i) if values[j] < v), default=0))
    return max(best, default=0)


def test_increasing_is_a_longest_one():
    rng = random.Random(1)
    for _ in range(500):
        values = rng.sample(range(40), rng.randint(0, 15))
        places = licenses.increasing(values)
        chosen = [values[i] for i in places]
        assert chosen == sorted(set(chosen)) and places == sorted(places)
        assert len(chosen) == longest_increasing(values)


def test_alignment_is_common_and_exact_for_unique_words():
    rng = random.Random(2)
    for _ in range(500):
        a = rng.choices("abcdefgh", k=rng.randint(0, 12))
        b = rng.choices("abcdefgh", k=rng.randint(0, 12))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) <= lcs(a, b)
        c, d = rng.sample(range(30), 12), rng.sample(range(30), 12)  # every word unique on its side
        assert len(licenses.align(c, d)) == lcs(c, d)


def made(coverage=0.8):
    templates = [licenses.Template(n, t, coverage) for n, t in licenses.TEMPLATES.items()]
    return templates, frozenset(w for t in templates for w in t.telling)


def test_every_template_is_found_whole_and_damaged():
    templates, vocabulary = made()
    rng = random.Random(3)
    for name, notice in licenses.TEMPLATES.items():
        before, after = text(rng, 500), text(rng, 500)
        t = f"{before}\n{notice}\n{after}"
        (hit,) = licenses.scan(t, templates, vocabulary, 0.8)
        assert hit[0] == name and hit[3] == 1.0
        assert licenses.words_of(t[hit[1]:hit[2]]) == licenses.words_of(notice)
        words = notice.split()
        if len(words) > 25:  # a word in ten replaced, line breaks elsewhere
            damaged = "\n * ".join(" ".join("zzz" if i % 10 == 5 else w for i, w in enumerate(words)).split(", "))
            (hit,) = licenses.scan(f"{before} {damaged} {after}", templates, vocabulary, 0.8)
            assert hit[0] == name and 0.8 <= hit[3] < 1


def test_many_notices_in_one_text():
    templates, vocabulary = made()
    t = ("Released under the MIT License. " * 40 + "gap " * 300 + licenses.TEMPLATES["GPL"] + " gap " * 50
         + licenses.TEMPLATES["MIT-notice"])
    names = [h[0] for h in licenses.scan(t, templates, vocabulary, 0.8)]
    assert names[-2:] == ["GPL", "MIT-notice"] and set(names[:-2]) == {"MIT"} and len(names) > 10


def test_repeated_notices_are_each_found():
    templates, vocabulary = made()
    rng = random.Random(6)
    for name, notice in licenses.TEMPLATES.items():
        reach = len(licenses.words_of(notice))
        for n in (1, 2, 3, 4):
            for gap in (0, 1, reach // 2, reach, 2 * reach):
                row = (" " + "gap " * gap).join([notice] * n)
                for before, after in ((0, 0), (0, 300), (300, 0), (300, 300), (reach // 2, 2)):
                    t = f"{text(rng, before)}\n{row}\n{text(rng, after)}"
                    hits = licenses.scan(t, templates, vocabulary, 0.8)
                    assert [h[0] for h in hits] == [name] * n, (name, n, gap, before, after)
                    assert all(licenses.words_of(t[a:b]) == licenses.words_of(notice) for _, a, b, _ in hits)


def test_repeated_damaged_notices_are_each_found():
    templates, vocabulary = made()
    words = licenses.TEMPLATES["MIT-notice"].split()
    damaged = " ".join("zzz" if i % 10 == 5 else w for i, w in enumerate(words))
    for n in (2, 3, 4):
        hits = licenses.scan(" ".join([damaged] * n), templates, vocabulary, 0.8)
        assert [h[0] for h in hits] == ["MIT-notice"] * n


def test_plain_texts_have_none():
    templates, vocabulary = made()
    rng = random.Random(5)
    for n in (0, 1, 50, 3000):
        assert licenses.scan(text(rng, n), templates, vocabulary, 0.8) == []
    assert licenses.scan("under the license of the public, version of this work", templates, vocabulary, 0.8) == []


def test_table(spark):
    data = rows() + [(900, "x Licensed under CC BY-NC 4.0. y", "en", "a", 0, 0, "", 0, "", "")]
    got = licenses.license_spans(frame(spark, data)).collect()
    assert len(got) == len(data)
    hits = [r for r in got if r.n_licenses]
    assert [(r.doc_id, r.licenses, r.spans) for r in hits] == [(900, "CC-BY-NC", "CC-BY-NC:2:29:1.000")]
    assert licenses.license_spans(frame(spark, [])).count() == 0


def test_like_notices_have_their_own_names():
    """The GNU notices share nearly all words; each is reported as itself."""
    templates, vocabulary = made()
    rng = random.Random(9)
    for name in ("GPL-notice", "AGPL-notice", "LGPL-notice", "GPL-3.0-text", "LGPL-2.1-text", "Artistic-2.0-text"):
        t = f"{text(rng, 30)} {licenses.TEMPLATES[name]} {text(rng, 30)}"
        assert [h[0] for h in licenses.scan(t, templates, vocabulary, 0.8)] == [name]


def brute_scan(t, templates, coverage):
    """Names found by aligning every window of the text with every template."""
    words, hits = licenses.words_of(t), []
    for m in templates:
        best = []
        for lo in range(len(words)):
            for hi in range(lo + 1, min(len(words), lo + 2 * len(m.words)) + 1):
                pairs = licenses.align(words[lo:hi], m.words)
                if len(pairs) >= coverage * len(m.words) - 1e-9:
                    best.append((m.name, lo + pairs[0][0], lo + pairs[-1][0] + 1, len(pairs) / len(m.words), len(pairs)))
        hits += licenses.apart(best, lambda h: (-h[4], h[2] - h[1], h[1]))
    return [h[0] for h in licenses.apart(hits, lambda h: (-h[4], -h[3], h[1], h[0]))]


def test_scan_against_every_window():
    short = {n: t for n, t in licenses.TEMPLATES.items() if len(licenses.words_of(t)) <= 13}
    templates = [licenses.Template(n, t, 0.8) for n, t in short.items()]
    vocabulary = frozenset(w for t in templates for w in t.telling)
    rng = random.Random(12)
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(0, 3)):
            words = short[rng.choice(sorted(short))].split()
            if rng.random() < 0.5 and len(words) > 4:
                words[rng.randrange(len(words))] = "zzz"
            parts += [" ".join(words), " ".join(rng.choice(["license", "the", "gap", "under", "work"])
                                                for _ in range(rng.randint(0, 6)))]
        t = " ".join(parts)
        assert [h[0] for h in licenses.scan(t, templates, vocabulary, 0.8)] == brute_scan(t, templates, 0.8), t
