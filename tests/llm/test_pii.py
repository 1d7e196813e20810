"""op1: base spans by plain regular expressions, disclosure by hand counts."""

import hashlib
import math
import random
import re

from earworm.llm import pii
from llm_corpus import SCHEMA, frame, rows

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return "".join(c for c in s if c in "0123456789")


def luhn(s):
    total = 0
    for i, c in enumerate(s[::-1]):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_spans(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(digits(m[0])) <= 15]


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    for _ in range(6000):
        t = "".join(rng.choice(["a", ".", "@", "b.c", "-", "1", "23", "255", "256", " ", "+", "(", "4", "é", "_%", "٣",
                                "4111111111111111", "4111 1111 1111 1111", "x@y.z"]) for _ in range(rng.randint(1, 18)))
        assert pii.base_spans(t) == plain_spans(t), t
    assert pii.base_spans("a" * 50_000 + "1" * 50_000) == []


def test_contract_columns(spark):
    data = rows() + [(800, "Mail a.b@c.de, +49 30 1234567 or 10.0.0.255!", "en", "a", 0, 0, "", 0, "", "")]
    from earworm.session import checkpoint_dir

    path = f"{checkpoint_dir(spark)}/pii-docs"
    frame(spark, data).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    got = sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans)
                 for r in pii.op1_pii(spark, path).collect())
    want = []
    for d in data:
        spans = plain_spans(d[1] or "")
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((str(d[0]), *[sum(s[0] == k for s in spans) for k in pii.BASE_KINDS],
                     hashlib.sha256(listed.encode()).hexdigest(), listed))
    assert got == sorted(want)


def corpus():
    """An address that is always near Zyglot, a town half the time; the other
    texts hold plain words, and words with Zyglot's first letters."""
    rng = random.Random(1)
    plain = "one two three four five six seven eight nine ten".split()
    out = []
    for i in range(12):
        town = "Marzby" if i % 2 else "there"
        out.append(f"{rng.choice(plain)} Zyglot {rng.choice(plain)} {rng.choice(plain)} ann@ex.org {town} {rng.choice(plain)}")
    out += [" ".join(rng.choice(plain) for _ in range(12)) for _ in range(200)]
    out += [f"Marzby {rng.choice(plain)} zygote zygoma {rng.choice(plain)}" for _ in range(40)]
    return out


def test_disclosure_and_generalisation(spark):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: [(s.kind, r.text[s.start:s.end]) for s in r._spans] for r in pii.find_private(df).collect()}
    n = len(texts)
    assert math.log(12 * n / (12 * 12)) / math.log(n / 12) >= 0.8  # Zyglot
    assert math.log(12 * n / (12 * 52)) / math.log(n / 12) < 0.8   # zyg*
    assert math.log(6 * n / (12 * 46)) / math.log(n / 12) < 0.8    # Marzby
    assert all(("email", "ann@ex.org") in got[i] and ("class", "Zyglot") in got[i] for i in range(12))
    assert {x for i in range(12) for x in got[i]} == {("email", "ann@ex.org"), ("class", "Zyglot")} | {
        x for i in range(12) for x in got[i] if x[0] in ("term", "class") and x[1].lower() in ("there",)}
    assert all(not got[i] for i in range(12, n))
    # without the words that share its letters the class reveals as much: removed
    kept = [t for t in texts if "zygote" not in t]
    df = spark.createDataFrame(list(enumerate(kept)), "doc_id bigint, text string")
    assert all(("term", "Zyglot") in [(s.kind, r.text[s.start:s.end]) for s in r._spans]
               for r in pii.find_private(df).collect() if "Zyglot" in r.text)


def test_proven_terms_go_in_every_text(spark):
    texts = corpus()
    n = len(texts)
    far = ["ZYGLOT one two", "ann@ex.org " + "ten " * 30 + "zyglot x@zyglot.org"]
    df = spark.createDataFrame(list(enumerate(texts + far)), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: [(s.kind, r.text[s.start:s.end]) for s in r._spans] for r in pii.find_private(df).collect()}
    assert got[n] == [("class", "ZYGLOT")]
    assert got[n + 1] == [("email", "ann@ex.org"), ("email", "x@zyglot.org"), ("class", "zyglot")]
    assert all(("class", "Zyglot") in got[i] for i in range(12)) and len(got) == n + 2
    clean = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert clean[n] == "ZYG* one two" and clean[n + 1].endswith("ten zyg* [EMAIL]")
    # op1 keeps no texts
    kept = pii.find_private(df, keep=["doc_id"])
    assert kept.columns == ["doc_id", "_spans"]
    assert {r.doc_id: len(r._spans) for r in kept.collect()} == {i: len(s) for i, s in got.items()}


def test_one_document_or_one_copied_passage_proves_nothing(spark):
    texts = ["Zyglot lives at bob@ex.org near Oxbow"] * 30 + [f"plain words {i}" for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {s.kind for r in pii.find_private(df).collect() for s in r._spans} == {"email"}


def test_sanitised_texts(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate([*texts, None, ""])],
                               "doc_id bigint, text string, _row int, _spans string")
    out = pii.sanitised(df)
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == df.columns
    for i, t in enumerate(texts):
        assert "@" not in got[i].text and "Zyglot" not in got[i].text
        if i >= 12:
            assert got[i].text == t
        else:
            assert "[EMAIL]" in got[i].text and "zyg*" in got[i].text.lower()
    assert got[len(texts)].text is None and got[len(texts) + 1].text == ""
    assert pii.sanitise("ab cd ef", [("ip", 0, 4), ("card", 3, 5), ("term", 6, 8)]) == "[IP] [TERM]"


def test_windows_of_long_runs():
    t = "x" * 10_000 + " a@b.co " + "y" * 10_000
    (span,) = [s for s in pii.base_spans(t) if s[0] == "email"]
    near = pii.contexts(t, [span], 8)  # runs of any length are terms, known by a hash
    assert [t[c["start"]:c["end"]][0] for c in near if not c["is_class"]] == ["x", "y"]
    assert [c["term"] for c in near if c["is_class"]] == ["xxx*", "yyy*"]
    near = pii.contexts("one two a@b.co three", [("email", 8, 14)], 1)
    assert [(c["term"], c["start"]) for c in near if not c["is_class"]] == [("two", 4), ("three", 15)]


def test_windows_hold_their_words_at_any_distance():
    far = " ".join(["12 34; --"] * 400)
    t = f"one two {far} a@b.co {far} three {'x' * 10_000} five"
    (span,) = [s for s in pii.base_spans(t) if s[0] == "email"]
    near = [t[c["start"]:c["end"]] for c in pii.contexts(t, [span], 2) if not c["is_class"]]
    assert near == ["one", "two", "three", "x" * 10_000]
    assert all(len(c["term"]) <= pii.TERM_CHARS for c in pii.contexts(t, [span], 2))


def test_long_runs_are_assessed(spark):
    run, rng = "Qu" + "ab" * 200, random.Random(2)
    texts = [f"{rng.choice(t)} {run} {'1 ' * 300} ann@ex.org {rng.choice(t)}" for t in [["red", "blue", "green"]] * 12]
    texts += [" ".join(rng.choice(["red", "blue", "green", "quail"]) for _ in range(12)) for _ in range(200)]
    texts += [f"only {run.upper()}", f"only {run}a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: {r.text[s.start:s.end].lower() for s in r._spans if s.kind in ("term", "class")}
           for r in pii.find_private(df).collect()}
    assert all(run.lower() in got[i] for i in (*range(12), len(texts) - 2)) and not got[len(texts) - 1]


def test_short_names_are_removed(spark):
    # the class liu* or i̇a* holds other words and does not reveal: only the name does
    for name, other in (("Liu", "liuto"), ("Li", "lido"), ("\u0130ab", "\u0130aron")):
        texts = [t.replace("Zyglot", name) for t in corpus()] + [f"{other} {i % 7} one" for i in range(60)]
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        got = [{(s.kind, r.text[s.start:s.end]) for s in r._spans} for r in pii.find_private(df).collect()
               if name in r.text.split()]
        assert len(got) == 12 and all(("term", name) in g and ("class", name) not in g for g in got)
        assert not any(name in r.text.split() or name + "*" in r.text for r in pii.sanitised(df).collect())


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert pii.sanitised(df).count() == 0 and pii.find_private(df.select("doc_id", "text")).count() == 0


def test_entity_terms_are_the_contexts_summed_up():
    rng = random.Random(4)
    for _ in range(200):
        t = " ".join(rng.choice(["ann@ex.org", "bob@ex.org", "10.0.0.1", "Red", "blue", "x" * 70, "12"])
                     for _ in range(rng.randint(0, 40)))
        spans, want = pii.base_spans(t), {}
        for c in pii.contexts(t, spans, 3):
            low, high = want.get((c["entity"], c["term"], c["is_class"]), (c["context"],) * 2)
            want[c["entity"], c["term"], c["is_class"]] = (min(low, c["context"]), max(high, c["context"]))
        assert {r[:3]: r[3:] for r in pii.entity_terms(t, spans, 3)} == want


def test_memory_of_a_long_text():
    """5 MB with 100,000 addresses: what is held at a time stays small."""
    import tracemalloc

    rng = random.Random(6)
    t = " ".join(f"word{rng.randint(0, 999)} u{i}@ex{i % 977}.org some other words here"[:52] for i in range(100_000))
    assert len(t) > 4_500_000
    spans = pii.base_spans(t)
    assert len(spans) == 100_000
    tracemalloc.start()
    n = sum(1 for _ in pii.entity_terms(t, spans, 8))
    assert n > 800_000 and tracemalloc.get_traced_memory()[1] < 150 << 20
    tracemalloc.stop()


def brute_terms(texts, window, threshold):
    """The revealing terms by their definition, text by text."""
    import math

    beside, holds, has, contexts = {}, {}, {}, {}
    for i, t in enumerate(texts):
        spans = pii.base_spans(t)
        names = {pii.term_of(w) for w in pii.WORD.findall(t)}
        for name in names | {n[:3] + "*" for n in names}:
            has.setdefault(name, set()).add(i)
        for c in pii.contexts(t, spans, window):
            key = (c["entity"], c["term"])
            beside.setdefault(key, set()).add(i)
            contexts.setdefault(key, set()).add(c["context"])
        for s in spans:
            holds.setdefault(pii.entity_of(t, *s), set()).add(i)
    n, out = len(texts), {}

    def reveals(entity, name):
        docs = beside.get((entity, name), ())
        n_c = len(holds[entity])
        if len(docs) < 2 or len(contexts[entity, name]) < 2 or n_c >= n:
            return False
        return math.log(len(docs) * n / (n_c * len(has[name]))) / math.log(n / n_c) >= threshold

    for entity, name in beside:
        if not name.endswith("*") and reveals(entity, name):
            removed = reveals(entity, name[:3] + "*") or len(name) <= 3
            out[name] = "term" if removed or out.get(name) == "term" else "class"
    return out


def test_revealing_terms_against_brute_force(spark):
    rng = random.Random(11)
    common = ["river", "house", "walks", "green", "paper", "stone", "under", "light"]
    names = {"ann@ex.org": ["Zyglot", "Liu"], "bob@ex.org": ["Oxbow", "Oxen"], "10.1.2.3": ["Qu" + "ab" * 40]}
    texts = []
    for entity, own in names.items():
        for _ in range(9):
            words = [rng.choice(common) for _ in range(rng.randint(4, 10))]
            words.insert(rng.randint(0, len(words)), entity)
            for o in own:
                if rng.random() < 0.9:
                    words.insert(rng.randint(0, len(words)), o)
            texts.append(" ".join(words))
    texts += [" ".join(rng.choice(["zygote", "oxygen", "liuto"] if rng.random() < .2 else common)
                       for _ in range(12)) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = brute_terms(texts, 8, 0.8)
    assert set(want.values()) == {"term", "class"}
    for r in pii.find_private(df).collect():
        mails = [(a, b) for k, a, b in pii.base_spans(r.text) if k == "email"]
        terms = [(kind if m.end() - m.start() > 3 else "term", m.start(), m.end()) for m in pii.WORD.finditer(r.text)
                 if (kind := want.get(pii.term_of(m[0]))) and not pii._inside(mails, *m.span())]
        got = [(s.kind, s.start, s.end) for s in r._spans if s.kind in ("term", "class")]
        assert got == sorted(terms, key=lambda s: (s[0] != "term", s[1]))
