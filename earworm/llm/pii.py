"""Personal data and the terms that reveal it (operator 1).

Base matches (email, ip, card, phone) are the protected entities: kind and
normalised value.  How much a term reveals an entity is estimated from the
corpus: with n_c documents that hold entity c, n_t that hold term t and n_ct in
which t stands within ``window`` words of a mention of c, out of N,

    disclosure(c, t) = PMI(c; t) / IC(c) = ln(n_ct N / (n_c n_t)) / ln(N / n_c)

is 1 if t is only ever found beside c.  A term at or above ``threshold`` is
generalised to its class (its first letters and ``*``) if the class's own
disclosure is below the threshold and the term has further letters, which the
class leaves out, and removed otherwise; where it stands, near
a mention or not, and in every text.  One context proves nothing about a
corpus: a term counts only if it is found with the entity in two documents and
in two different contexts, so a word that is unique, or merely copied along
with its passage, stays.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from earworm.llm.store import documents, neutral, shared_path, written

BASE_KINDS = ("email", "ip", "card", "phone")
#: In the order in which spans are listed.
KINDS = (*BASE_KINDS, "term", "class")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
WORD = re.compile(r"[^\W\d_]+")
CLASS_LETTERS = 3
#: Longer runs of letters are known by their first letters and a 64-bit hash.
TERM_CHARS = 64


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, found from the @:
    the local part is the whole run before it, so no start is tried twice."""
    out, bound, at = [], 0, text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at)
        head = text[bound:at]
        start = bound + len(head.rstrip(LOCAL))
        if m and start < at:
            out.append((start, m.end()))
            bound = m.end()
        else:
            bound = at + 1
        at = text.find("@", max(bound, at + 1))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Four dotted groups at a time from the left of each dotted chain."""
    out = []
    for m in DOTTED.finditer(text):
        groups = m[0].split(".")
        at = m.start()
        for i in range(0, len(groups) - 3, 4):
            four = groups[i: i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in four):
                out.append((at, end))
            at = end + 1
    return out


def luhn(digits: str) -> bool:
    return sum(int(d) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)]
               for i, d in enumerate(reversed(digits))) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def cards(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CARD.finditer(text) if 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every base match, by kind as listed, then start."""
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [("ip", *s) for s in ips(text)]
        out += [("card", *s) for s in cards(text)]
        out += [("phone", *s) for s in phones(text)]
    return out


def entity_of(text: str, kind: str, start: int, end: int) -> int:
    """64-bit hash of kind and normalised value (the value itself is not kept)."""
    value = text[start:end]
    value = digits_of(value) if kind in ("card", "phone") else value.lower()
    return xxhash.xxh64_intdigest(f"{kind}:{value}") - (1 << 63)


def class_of(term: str) -> str:
    return term[:CLASS_LETTERS] + "*"


def term_of(word: str) -> str:
    """What a word is counted as: its lower case, or, for a run of over
    ``TERM_CHARS``, first letters and hash, which no word is (# is no letter)."""
    term = word.lower()
    return term if len(term) <= TERM_CHARS else (
        f"{term[:CLASS_LETTERS]}#{xxhash.xxh64_hexdigest(term)}")


def _mentions(text: str, spans: list[tuple[str, int, int]], window: int):
    """(entity, [(start, end) of the words around], context) of each mention,
    all mentions of an entity in a row.  The words are found once for all
    mentions, so each has its ``window`` words a side, however far they are;
    a long text's words are two arrays of numbers."""
    mails = [(a, b) for kind, a, b in spans if kind == "email"]
    starts = np.fromiter((m.start() for m in WORD.finditer(text)), np.int64)
    ends = np.fromiter((m.end() for m in WORD.finditer(text)), np.int64)
    entities = [entity_of(text, *s) for s in spans]
    places = zip(np.searchsorted(ends, [a for _, a, _ in spans], "right").tolist(),
                 np.searchsorted(starts, [b for _, _, b in spans], "left").tolist())
    places = list(places)
    for i in sorted(range(len(spans)), key=entities.__getitem__):
        before, after = places[i]
        around = [*range(max(0, before - window), before), *range(after, min(len(starts), after + window))]
        words = [(a, b) for a, b in zip(starts[around].tolist(), ends[around].tolist()) if not _inside(mails, a, b)]
        yield entities[i], words, xxhash.xxh64_intdigest(" ".join(text[a:b].lower() for a, b in words)) - (1 << 63)


def contexts(text: str, spans: list[tuple[str, int, int]], window: int) -> list[dict]:
    """The words around each mention; ``n`` is 1 where the term stands with the
    entity for the first time in this text."""
    out, seen = [], set()
    for entity, words, context in _mentions(text, spans, window):
        for a, b in words:
            term = term_of(text[a:b])
            for name, is_class in ((term, False), (class_of(term), True)):
                out.append({"entity": entity, "term": name, "is_class": is_class, "start": a, "end": b,
                            "context": context, "n": int((entity, name) not in seen)})
                seen.add((entity, name))
    return out


def entity_terms(text: str, spans: list[tuple[str, int, int]], window: int):
    """(entity, term or class, is_class, least and greatest context) of what
    stands near each entity, each once: what the statistics need of a text.
    One entity's terms are held at a time."""
    held, near = None, {}

    def of_one():
        for (name, is_class), (low, high) in near.items():
            yield held, name, is_class, low, high

    for entity, words, context in _mentions(text, spans, window):
        if entity != held:
            yield from of_one()
            held, near = entity, {}
        for a, b in words:
            term = term_of(text[a:b])
            for key in ((term, False), (class_of(term), True)):
                low, high = near.get(key, (context, context))
                near[key] = (min(low, context), max(high, context))
    yield from of_one()


def _inside(mails: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether a word overlaps an address (the other kinds hold no letters);
    ``mails`` are disjoint and ascending."""
    at = bisect_left(mails, (b, 0)) - 1
    return at >= 0 and mails[at][1] > a


SCAN = ("part string, row bigint, spans array<struct<kind:string,start:int,end:int>>, entities array<bigint>, "
        "term string, n_docs bigint, entity bigint, is_class boolean, c0 bigint, c1 bigint")
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_ARROW = [("_part", pa.string()), ("_row", pa.int64()), ("_spans", pa.list_(_SPAN)), ("_entities", pa.list_(pa.int64())),
          ("_term", pa.string()), ("_n_docs", pa.int64()), ("_entity", pa.int64()), ("_is_class", pa.bool_()),
          ("_c0", pa.int64()), ("_c1", pa.int64())]
_DDL = ", ".join("_" + c for c in SCAN.split(", "))
#: Terms that a task counts before it passes the counts on, and (entity, term)
#: that it passes on together.
HELD_TERMS, HELD_NEAR = 500_000, 20_000
#: Bits that tell which terms or rows cannot match, whatever their number.
SLOTS = 1 << 24


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _scan(docs: DataFrame, text: str, keep: list[str], window: int, path: str) -> StructType:
    """One pass over the texts writes three tables: ``_part=row``, the rows
    with the columns to keep, spans and entities, ``_part=near``, what stands
    near the entities of a text, and ``_part=term``, partial document counts of
    terms and classes.  Returns their schema."""
    at, kept = docs.columns.index(text), [docs.columns.index(c) for c in keep]

    def scan(batches):
        from pyspark import TaskContext

        row, counts, schema = TaskContext.get().partitionId() << 33, {}, None

        def table(part: str, n: int, **values):
            given = {"_part": [part] * n, **values}
            return pa.RecordBatch.from_arrays(
                [pa.array(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type) for f in schema], schema=schema)

        def terms():
            return table("term", len(counts), _term=counts.keys(), _n_docs=counts.values())

        def near(held: list[tuple]):
            entity, term, is_class, low, high = zip(*held)
            return table("near", len(held), _entity=entity, _term=term, _is_class=is_class, _c0=low, _c1=high)

        for batch in batches:
            schema = pa.schema([*(batch.schema.field(i) for i in kept), *[pa.field(*f) for f in _ARROW]])
            rows, spans, entities, held = [], [], [], []
            for value in batch.column(at):
                whole = value.as_py() or ""
                found = base_spans(whole)
                for record in entity_terms(whole, found, window) if found else ():
                    held.append(record)
                    if len(held) >= HELD_NEAR:
                        yield near(held)
                        held = []
                rows.append(row)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
                entities.append(sorted({entity_of(whole, *s) for s in found}))
                row += 1
                words = {term_of(w) for w in {m[0] for m in WORD.finditer(whole)}}
                for term in words:
                    counts[term] = counts.get(term, 0) + 1
                for term in {w[:CLASS_LETTERS] for w in words}:
                    counts[term + "*"] = counts.get(term + "*", 0) + 1
                if len(counts) >= HELD_TERMS:
                    yield terms()
                    counts.clear()
            if held:
                yield near(held)
            own = {f"_{name}": values for name, values in zip(("row", "spans", "entities"), (rows, spans, entities))}
            kept_columns = {batch.schema.field(i).name: batch.column(i) for i in kept}
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [kept_columns[f.name] if f.name in kept_columns else pa.array(["row"] * n) if f.name == "_part"
                 else pa.array(own[f.name], f.type) if f.name in own else pa.nulls(n, f.type) for f in schema], schema=schema)
        if counts:
            yield terms()

    out = StructType([*(docs.schema[c] for c in keep), *StructType.fromDDL(_DDL).fields])
    docs.mapInArrow(scan, out).write.partitionBy("_part").option("compression", "zstd").parquet(path)
    return out


def _slots(df: DataFrame, number) -> DataFrame:
    """(slot_word, bits): a bit for each of ``SLOTS`` that a ``number`` falls
    on; at most SLOTS / 64 rows."""
    slot = F.pmod(number, F.lit(SLOTS).cast("bigint"))
    return (df.select(F.shiftright(slot, 6).alias("slot_word"), F.pmod(slot, F.lit(64)).cast("int").alias("bit"))
            .groupBy("slot_word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))


def _occurrences(rows: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """(_row, term, places) of each row and each term in it that may be one of
    ``terms``: all that are, and some that share a slot with one."""
    table = _slots(terms, F.crc32(F.encode("term", "UTF-8"))).toArrow()
    bits = np.zeros(SLOTS // 64, "<i8")
    bits[table["slot_word"].to_numpy()] = table["bits"].to_numpy()
    sent = rows.sparkSession.sparkContext.broadcast(bits.tobytes())
    names = ["_row", "term", "places"]
    place = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def find(batches):
        held = sent.value
        known: dict[str, str | None] = {}  # words met: their term if it may be asked for

        def asked(term: str) -> str | None:
            slot = zlib.crc32(term.encode()) % SLOTS
            return term if held[slot >> 3] >> (slot & 7) & 1 else None

        def term_at(word: str) -> str | None:
            if len(word) > TERM_CHARS:
                return asked(term_of(word))
            if word not in known:
                if len(known) >= HELD_TERMS:
                    known.clear()
                known[word] = asked(term_of(word))
            return known[word]

        for batch in batches:
            at, terms, places, ends = [], [], array("i"), [0]
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole = value.as_py() or ""
                if not any(map(term_at, {m[0] for m in WORD.finditer(whole)})):
                    continue
                mails, here = emails(whole), {}
                for m in WORD.finditer(whole):
                    term = term_at(m[0])
                    if term is not None and not _inside(mails, *m.span()):
                        here.setdefault(term, array("i")).extend(m.span())
                at += [row] * len(here)
                terms += here.keys()
                for found in here.values():
                    places.extend(found)
                    ends.append(len(places) // 2)
            both = np.frombuffer(places, np.int32).reshape(-1, 2)
            spans = pa.StructArray.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], fields=list(place))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), pa.array(terms, pa.string()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)], names=names)

    return rows.select("_row", _quoted(text)).mapInArrow(
        find, "_row bigint, term string, places array<struct<start:int,end:int>>")


def find_private(docs: DataFrame, text: str = "text", window: int = 8, threshold: float = 0.8,
                 keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``_spans``: every base span and
    every term span of the row, by kind as listed, then start.

    The texts are read once and written, with what was found, to the shared
    folder.  Term counts are added up per task, then by a partial aggregate;
    the statistics are joins of aggregates.  The terms that reveal an entity
    then meet the distinct (row, term) of the written texts; bits that are sent
    to all tasks leave out most of those that match none.  An entity or a term
    that a third of all rows hold is a skewed join that adaptive execution
    splits.  Null or empty text: no spans.  Repeated rows keep their own spans
    (rows are numbered when they are written).  An empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    path, keep = shared_path(spark, "pii"), docs.columns if keep is None else keep
    schema = _scan(docs, text, keep if text in keep else [*keep, text], window, path)
    scanned = spark.read.schema(schema).parquet(path)
    rows = scanned.where("_part = 'row'").drop("_part", "_term", "_n_docs", "_entity", "_is_class", "_c0", "_c1")
    n_docs = rows.count()
    pairs = (scanned.where("_part = 'near'")
             .groupBy(F.col("_entity").alias("entity"), F.col("_term").alias("term"), F.col("_is_class").alias("is_class"))
             .agg(F.count(F.lit(1)).alias("n_ct"), F.min("_c0").alias("c0"), F.max("_c1").alias("c1"))
             .where("n_ct >= 2 and c0 <> c1").drop("c0", "c1"))
    entities = rows.select(F.explode("_entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_c"))
    terms = (scanned.where("_part = 'term'").select(F.col("_term").alias("term"), F.col("_n_docs").alias("n"))
             .groupBy("term").agg(F.sum("n").alias("n_t")))
    scored = pairs.join(entities, "entity").where(F.col("n_c") < n_docs).join(terms, "term").select(
        "entity", "term", "is_class",
        (F.log(F.col("n_ct") * F.lit(float(n_docs)) / (F.col("n_c") * F.col("n_t").cast("double")))
         / F.log(F.lit(float(n_docs)) / F.col("n_c")) >= threshold).alias("reveals"))
    # a class reveals what its own count says; unproven ones do not
    revealing = scored.where("reveals")
    classes = revealing.where("is_class").select("entity", F.col("term").alias("_class"), F.lit(True).alias("closed"))
    verdicts = written(
        revealing.where("not is_class")
        .withColumn("_class", F.concat(F.substring("term", 1, CLASS_LETTERS), F.lit("*")))
        .join(classes, ["entity", "_class"], "left")
        .select("term", F.when(F.col("closed") | (F.length("term") <= CLASS_LETTERS), F.lit("term"))
                .otherwise(F.lit("class")).alias("kind"))
        .groupBy("term").agg(F.max("kind").alias("kind")), "verdicts")  # removed beats generalised
    found = written(
        _occurrences(rows, text, verdicts).join(verdicts, "term")
        .select("_row", F.transform("places", lambda p: F.struct(  # lower case can be longer than what stands there
            F.when(p["end"] - p["start"] <= CLASS_LETTERS, F.lit("term")).otherwise(F.col("kind")).alias("kind"),
            p["start"].alias("start"), p["end"].alias("end"))).alias("places"))
        .groupBy("_row").agg(F.array_sort(F.flatten(F.collect_list("places")), lambda a, b: F.when(
            a["kind"] == b["kind"], a["start"] - b["start"]).when(a["kind"] == "term", -1).otherwise(1)).alias("_terms")),
        "terms")
    # rows that surely hold no such term are not shuffled
    number = F.xxhash64("_row")
    slot = F.pmod(number, F.lit(SLOTS).cast("bigint"))
    marked = rows.select(*map(_quoted, keep), "_spans", "_row", F.shiftright(slot, 6).alias("slot_word"),
                         F.pmod(slot, F.lit(64)).cast("int").alias("_bit")).join(
        F.broadcast(_slots(found, number)), "slot_word", "left").withColumn(
        "_may", F.coalesce(F.expr("shiftright(bits, _bit) & 1L"), F.lit(0)) == 1)
    return marked.where("not _may").select(*map(_quoted, keep), "_spans").unionByName(
        marked.where("_may").join(found, "_row", "left").select(*map(_quoted, keep), F.concat(
            "_spans", F.coalesce("_terms", F.array().cast("array<struct<kind:string,start:int,end:int>>"))).alias("_spans")))


def sanitise(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with base spans as [KIND], removed terms as [TERM] and
    generalised ones as their class.  Where spans overlap, their union takes
    the name of the first.  Null stays null."""
    if text is None or not spans:
        return text
    out, at, upto = [], 0, 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans):
        if start < upto:
            upto = max(upto, end)
            at = upto
            continue
        out += [text[at:start], class_of(text[start:end]) if kind == "class" else f"[{kind.upper()}]"]
        at = upto = end
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, text: str = "text", window: int = 8, threshold: float = 0.8) -> DataFrame:
    """``docs`` with every private span and revealing term of ``text`` replaced."""
    rows, (name,) = neutral(docs, text)
    at = rows.columns.index(name)

    def apply(batches):
        for batch in batches:
            new = [sanitise(t, [(s["kind"], s["start"], s["end"]) for s in spans])
                   for t, spans in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())]
            columns = batch.columns[:-1]
            columns[at] = pa.array(new, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(batch.schema)[:-1]))

    found = find_private(rows, name, window, threshold)
    clean = found.where("size(_spans) = 0").drop("_spans")
    return clean.unionByName(found.where("size(_spans) > 0").mapInArrow(apply, rows.schema)).toDF(*docs.columns)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and term spans of all documents."""
    found = find_private(documents(spark, sf_dir).select("doc_id", "text"), keep=["doc_id"])

    def digest(batches):
        for batch in batches:
            ids, spans = batch.column(0), batch.column(1).to_pylist()
            text = [[f"{s['kind']}:{s['start']}:{s['end']}" for s in one] for one in spans]
            base = [[x for x, s in zip(t, one) if s["kind"] in BASE_KINDS] for t, one in zip(text, spans)]
            counts = [pa.array([sum(s["kind"] == k for s in one) for one in spans], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [ids, *counts[:4], pa.array([hashlib.sha256(",".join(b).encode()).hexdigest() for b in base]),
                 pa.array([",".join(t) for t in text], pa.string()), *counts[4:]],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term", "n_class"])

    return found.select("doc_id", "_spans").mapInArrow(
        digest, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, "
                "spans string, n_term bigint, n_class bigint")
