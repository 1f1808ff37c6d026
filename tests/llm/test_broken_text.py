"""Texts that are no UTF-8, which Spark keeps as they are: every operator and stage takes them."""

import pytest

import corpus_pipeline
from rapport.llm import alignment, decontaminate, html_text, importance, language, licenses, mixing, pieces, queries, secrets, sharding, simhash

WORDS = "the house of the lord is here now and we were all there to see it"


@pytest.fixture(scope="module")
def broken(spark):
    good = spark.createDataFrame([(i, f"{WORDS} {i}", "en", "a", 1) for i in range(6)], "doc_id long, text string, lang string, source string, n_chars long")
    bad = spark.sql(f"""SELECT * FROM VALUES
        (50L, cast(concat(cast('{WORDS} caf' AS binary), X'E920C3') AS string), 'en', 'b', 1L),
        (51L, cast(X'FFFE80' AS string), 'de', 'a', 1L),
        (52L, cast(concat(X'ED A0 80'::binary, cast('{WORDS}' AS binary)) AS string), NULL, 'a', 1L)
        AS t(doc_id, text, lang, source, n_chars)""".replace("X'ED A0 80'::binary", "X'EDA080'"))
    return good.union(bad)


def test_every_operator_reads_broken_texts(spark, broken):
    benchmark = spark.createDataFrame([(1, WORDS)], "item_id long, text string")
    vocabulary = pieces.read_model(queries.read_bytes(queries.PIECE_MODEL))
    bytes_ = alignment.byte_model_text(queries.read_bytes(queries.BYTE_MODEL))
    runs = {
        "op1": lambda: licenses.licenses(broken),
        "op3": lambda: sharding.shard(broken),
        "op5": lambda: language.identify(broken, language.learn(broken)),
        "op7": lambda: mixing.mix(broken),
        "op8": lambda: decontaminate.contamination(broken, benchmark),
        "op10": lambda: simhash.near_duplicates(broken),
        "op11": lambda: alignment.best_links(broken, bytes_, vocabulary),
        "op12": lambda: pieces.encode(broken, vocabulary),
    }
    for name, run in runs.items():
        assert sorted(r.doc_id for r in run().collect()) == [0, 1, 2, 3, 4, 5, 50, 51, 52], name
    assert importance.resample(broken, broken.select("doc_id"), share=0.5).count() >= 0
    assert secrets.scan(broken).count() >= 0


def test_broken_bytes_are_read_as_marks(spark, broken):
    found = {r.doc_id: r.lang_pred for r in language.identify(broken, language.learn(broken)).collect()}
    assert found[51] == "und" and found[50] != "und"
    pages = broken.selectExpr("doc_id AS page_id", "'u' AS url", "text AS html")
    texts = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    assert texts[50] == f"{WORDS} caf� �" and texts[0] == f"{WORDS} 0"


def test_stages_keep_broken_bytes(spark, broken, tmp_path):
    benchmark = spark.createDataFrame([(1, "no such words are here at all today")], "item_id long, text string")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = broken
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
    kept = {r.doc_id: bytes(r.raw) for r in docs.selectExpr("doc_id", "cast(text AS binary) raw").collect()}
    assert 50 in kept and kept[50].endswith(b"caf\xe9 \xc3") and 51 not in kept


def test_stages_keep_columns_of_any_names(spark):
    rows = [(i, f"{WORDS} number {i // 2}", "a", i, -i) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _row_hash long, x long")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and all(r.doc_id == r._row_hash for r in kept.collect())
    twice = docs.select("doc_id", "text", "source", docs["_row_hash"].alias("n.n"), docs["x"].alias("x"), docs["doc_id"].alias("x"))
    out = mixing.mixed(twice)
    assert out.columns == twice.columns and sorted({tuple(r) for r in out.collect()}) == sorted({tuple(r) for r in twice.collect()})
