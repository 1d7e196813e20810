"""The pipeline's stages on planted cases, and the registered queries."""

import collections
import random

import pytest

import __spark_entry__ as entry_mod
import corpus_pipeline
from conftest import SF001
from earworm.llm import pii, simhash
from earworm.llm.registry import ORACLE, QUERIES
from earworm.session import checkpoint_dir

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def planted(spark):
    """sf0.001 with toxic texts, copies, an address and odd rows added."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    rng = random.Random(1)
    base = [r.text for r in docs.orderBy("doc_id").limit(60).collect()]
    rows, marks = [], []
    for i in range(120):  # labelled: half toxic by a word that no other text has
        words = " ".join(rng.choice(base).split()[:40]).split(" ")
        if i % 2:
            words.insert(5, "vilewort")
        rows.append((10_000 + i, " ".join(words) + f" {rng.random()}", "en", "src1", 0))
        marks.append((10_000 + i, 1, i % 2))
    long = " ".join(str(rng.random()) for _ in range(300))
    rows += [(20_000, "you vilewort " + long[:200], "en", "src2", 0), (20_001, long, "en", "src2", 0),
             (20_002, long, "en", "src3", 0), (20_003, long + " once", "en", "src3", 0),
             (20_004, "write to me at planted.person@example.org today", "en", "src4", 0),
             (20_005, None, None, None, None), (20_006, "", "en", "src5", 0)]
    path = f"{checkpoint_dir(spark)}/planted"
    docs.select(*[c.split()[0] for c in SCHEMA.split(", ")]).unionByName(
        spark.createDataFrame(rows, SCHEMA)).repartition(5).write.parquet(f"{path}/documents.parquet")
    labels.unionByName(spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")).write.parquet(
        f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, planted):
    """Each stage's rows, every one written and read again."""
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{checkpoint_dir(spark)}/stage-{name}"
        stage(spark, docs, planted).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
    return dict(out)


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    for name in ("toxicity", "near_dedup", "pii", "mixing"):
        assert stages[name].columns == stages["documents"].columns


def test_toxic_documents_go(stages):
    kept = texts(stages["toxicity"])
    assert 20_000 not in kept and not any(10_000 + i in kept for i in range(1, 120, 2))
    assert all(10_000 + i in kept for i in range(0, 120, 2)) and 20_005 in kept and 20_006 in kept


def test_one_of_each_group_stays(stages):
    kept, before = texts(stages["near_dedup"]), texts(stages["toxicity"])
    assert 20_001 in kept and 20_002 not in kept
    fps = {i: simhash.fingerprint(t) for i, t in before.items()}
    for i in before:  # whoever went is linked, through others that went, to one that stays
        if i not in kept:
            reached, work = {i}, [i]
            while work:
                x = work.pop()
                near = {j for j in before if j not in reached and (fps[x] ^ fps[j]).bit_count() <= 3}
                reached |= near
                work += near
            assert len(reached & kept.keys()) == 1 and min(reached) in kept


def test_private_data_is_replaced(stages):
    before, after = texts(stages["near_dedup"]), texts(stages["pii"])
    assert "[EMAIL]" in after[20_004] and "planted.person" not in after[20_004]
    assert before.keys() == after.keys()
    for i, t in before.items():
        if not pii.base_spans(t or ""):
            assert after[i] == t
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in stages["pii"].collect())


def test_the_mix_repeats_and_drops(stages):
    often = collections.Counter(r.doc_id for r in stages["mixing"].collect())
    assert max(often.values()) == 2 and often.keys() <= texts(stages["pii"]).keys()


def test_every_text_that_is_left_is_encoded(stages):
    rows = stages["encoding"].collect()
    assert len(rows) == stages["mixing"].count() and all(r.decoded_equal for r in rows)


def test_run_gives_the_last_stage(spark, planted, stages):
    got = corpus_pipeline.run(spark, planted)
    want = stages["encoding"]
    assert sorted((r.doc_id, r.ids_crc32) for r in got.collect()) == sorted((r.doc_id, r.ids_crc32) for r in want.collect())


def test_stages_are_as_dealt():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "pii", "mixing", "encoding"]


def test_one_query_for_each_operator():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES)
    assert numbers == list(range(1, 14))
    assert QUERIES.keys() <= entry_mod.queries().keys() and "pipeline" in entry_mod.queries()
    assert ORACLE.keys() <= QUERIES.keys()


#: Queries of conversations, and of filter orders, give other rows.
OF_OTHER_ROWS = {"op12_conversation_repair", "op13_filter_audit"}


@pytest.mark.parametrize("key", sorted(QUERIES.keys() - OF_OTHER_ROWS))
def test_query_gives_a_row_for_each_document(spark, key):
    assert QUERIES[key](spark, SF001).count() == spark.read.parquet(f"{SF001}/documents.parquet").count()


def test_queries_of_other_rows(spark):
    turns = spark.read.parquet(f"{SF001}/conversations.parquet")
    assert QUERIES["op12_conversation_repair"](spark, SF001).count() == turns.select("conv_id").distinct().count()
    langs = spark.read.parquet(f"{SF001}/documents.parquet").selectExpr("coalesce(lang, '')").distinct()
    assert QUERIES["op13_filter_audit"](spark, SF001).count() == 600 * langs.count()
