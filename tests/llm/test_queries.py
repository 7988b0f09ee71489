"""The registered queries against their SQL, and what their contracts say of types, plans and whole tables."""

import hashlib

import pytest

import corpus_pipeline
from churnflow.llm import bpe, decontamination, secret_scan, simhash
from churnflow.llm.queries import QUERIES
from churnflow.llm.sql import ORACLE
from tests.llm import test_simhash
from tests.oracle import connect, difference

SCHEMAS = {
    "op1_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
                          "n_near bigint, near_sha256 string",
    "op2_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op3_topk_search": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op4_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op5_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op7_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op8_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op9_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op10_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op11_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op12_infilling": "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string",
    "op13_ranked_search": "item_id bigint, rank int, doc_id bigint, score bigint",
}


@pytest.fixture(scope="module")
def answers(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_answer(spark, sf_dir, answers, name):
    assert difference(QUERIES[name](spark, sf_dir), answers, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_columns(spark, sf_dir, name):
    assert {f"{c} {t}" for c, t in QUERIES[name](spark, sf_dir).dtypes} == set(SCHEMAS[name].split(", "))


@pytest.mark.parametrize("name", ["op1_decontamination", "op6_pii", "op8_secrets"])
def test_native_plans_have_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_simhash_over_the_whole_table(spark, sf_dir, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = sorted(repr((r.doc_id, r.fingerprint, r.component_id)) for r in QUERIES["op4_simhash"](spark, sf_dir).collect())
    assert got == test_simhash.brute(rows)


def test_bpe_over_the_whole_table(spark, sf_dir, documents):
    from tokenizers import Tokenizer

    library, want = Tokenizer.from_file(corpus_pipeline.tokenizer_path()), {}
    for r in documents.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op10_bpe"](spark, sf_dir).collect()} == want


def test_pii_over_the_whole_table(spark, sf_dir, documents):
    got = {r.doc_id: r for r in QUERIES["op6_pii"](spark, sf_dir).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    changed = [r for r in rows if got[r.doc_id].text != r.text]
    counts = [c for c in next(iter(got.values())).asDict() if c.startswith("n_")]
    assert {r.doc_id for r in changed} == {i for i, r in got.items() if sum(r[c] for c in counts)}
    assert changed and all(len(got[r.doc_id].text) >= len(r.text) - 60 for r in changed)


def test_pipeline_stage_by_stage(spark, sf_dir, documents):
    """Every stage keeps what its own operator says of its own input."""
    stages, docs = dict(corpus_pipeline.STAGES), documents
    assert list(stages) == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scans", "BPE encoding and decoding"]
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    after = [docs]
    for stage in list(stages.values())[:-1]:
        after.append(stage(spark, after[-1], sf_dir).cache())
        assert after[-1].columns == documents.columns
    good = {r.doc_id for r in QUERIES["op5_quality"](spark, sf_dir).collect() if r.predicted}
    assert ids(after[1]) == good
    groups = simhash.near_duplicates(after[1]).collect()
    assert ids(after[2]) == {r.component_id for r in groups}
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    clean = {r.doc_id for r in decontamination.contamination(after[2], benchmark).collect() if not r.n_hit}
    assert ids(after[3]) == clean and len(clean) > 0.5 * len(ids(after[2]))
    assert ids(after[4]) == clean
    left = secret_scan.secrets(after[4]).where("exists(spans, s -> s.kind in ('assign', 'access', 'hex'))")
    assert left.count() == 0
    last = stages["BPE encoding and decoding"](spark, after[4], sf_dir)
    whole = bpe.encode_decode(after[4], corpus_pipeline.tokenizer_path()).select("doc_id", "ids", *bpe.digests())
    assert sorted(map(repr, last.collect())) == sorted(map(repr, whole.collect()))
    assert sorted(map(repr, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(repr, last.collect()))


def test_stages_take_empty_tables(spark, sf_dir, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
