"""Registered queries against their SQL, and the pipeline against plain Python."""

import hashlib
import os

import duckdb
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from fleetlens.llm.bpe_codec import read_ranks
from fleetlens.llm.oracle import ORACLE_SQL
from fleetlens.llm.registry import QUERIES
from fleetlens.llm.secret_scan import all_spans, redact

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    rows = sorted(tuple(r[i] for i in at) for r in want.fetchall())
    assert rows and sorted(tuple(r[c] for c in columns) for r in got.collect()) == rows


def test_contract_columns(spark):
    columns = {
        2: "doc_id bigint, held_out boolean, score double, predicted int",
        4: "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
        6: "doc_id bigint, n_matches bigint, licenses string, best_dice double, spans string",
        7: "doc_id bigint, n_shingles bigint, component_id bigint",
        9: "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
        10: "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        11: "page_id bigint, url string, text string, n_chars bigint, n_blocks int, n_content int",
        12: "item_id bigint, rank int, doc_id bigint, score bigint",
        13: "lang string, source string, part string, item string, value bigint, rank int",
    }
    for name, query in QUERIES.items():
        if (n := int(name[2:].split("_")[0])) in columns:
            assert ", ".join(f"{c} {t}" for c, t in query(spark, SF).dtypes) == columns[n]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    order = [name for name, _ in corpus_pipeline.STAGES]
    assert order == ["toxicity", "near_duplicates", "secrets", "mixing", "encoding"]
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: {r["doc_id"]: r for r in df.collect()}

    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op2_toxicity"](spark, SF).collect()}
    mild = stages["toxicity"](spark, docs, SF).cache()
    assert mild.schema == docs.schema and set(rows(mild)) == {i for i, p in scores.items() if not p}

    from test_jaccard import plain

    texts = [(r["doc_id"], r["text"]) for r in mild.collect()]
    heads = {x.rstrip(")").split(", ")[-1] for x in plain(texts, 80, 5)}
    single = stages["near_duplicates"](spark, mild, SF).cache()
    assert single.schema == docs.schema and {str(i) for i in rows(single)} == heads

    masked = stages["secrets"](spark, single, SF).cache()
    assert masked.schema == docs.schema
    before, after = rows(single), rows(masked)
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r["text"] == redact(before[i]["text"], all_spans(before[i]["text"])[1]) and r["n_chars"] == len(r["text"])

    mixed = stages["mixing"](spark, masked, SF).cache()
    assert mixed.schema == docs.schema and 0 < mixed.count() and set(rows(mixed)) <= set(after)
    assert all(r["text"] == after[i]["text"] for i, r in rows(mixed).items())

    encoded = stages["encoding"](spark, mixed, SF).collect()
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(f.read()), special_tokens={})
    assert sorted(r["doc_id"] for r in encoded) == sorted(r["doc_id"] for r in mixed.collect())
    for r in encoded:
        text = after[r["doc_id"]]["text"]
        assert r["ids"] == library.encode_ordinary(text) and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    for df in (mild, single, masked, mixed):
        df.unpersist()


def test_run_on_documents(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"] and out.count() > 0


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def write_tables(spark, path, texts, labels):
    from llm_fixtures import rows_for

    spark.createDataFrame([r[:5] for r in rows_for(texts)], DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_pipeline_on_edge_rows(spark, tmp_path):
    """Null ids, texts, languages and sources, empty and very long texts, ties and repeated rows."""
    from llm_fixtures import EDGE_TEXTS

    mild = [(100 + i, f"plain words number {i} that say nothing of note and go on for a while, item {i * 7}") for i in range(60)]
    rude = [(300 + i, f"you vileword fool number {i}, such a vileword as {i * 3} others") for i in range(30)]
    texts = [*EDGE_TEXTS, *mild, *rude, (100, mild[0][1]), (400, mild[1][1]), (401, mild[1][1] + " x")]
    write_tables(spark, tmp_path, texts, [(i, 1, 0) for i, _ in mild] + [(i, 0, 1) for i, _ in rude] + [(None, 1, 1), (1, None, None)])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.schema == docs.schema, name
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in out}
    assert ids and ids <= {i for i, _ in texts} and not ids & {i for i, _ in rude} and not {400, 401} <= ids


def test_pipeline_on_empty_tables(spark, tmp_path):
    write_tables(spark, tmp_path, [], [])
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.collect() == [] and out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"]


def test_queries_on_empty_tables(spark, tmp_path):
    write_tables(spark, tmp_path, [], [])
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, query in QUERIES.items():
        assert query(spark, str(tmp_path)).collect() == [], name
