import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from lograft.llm import queries
from lograft.llm.jaccard_join import jaccard_components
from tests.conftest import SF001

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A few documents of the tables with every awkward row that a stage may meet."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    first = docs.orderBy("doc_id").first().text
    more = spark.createDataFrame(
        [(None, "a row without an id that says nothing special at all", "en", "s", 1), (9001, None, None, None, None), (9002, "", "en", None, 0),
         (9003, first, "en", "src1", 1), (9003, first, "en", "src1", 1), (9004, first + " and one more", "en", "src1", 1)], docs.schema)
    docs.unionByName(more).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_stages(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    seen = {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, corpus)
        out.write.parquet(f"{tmp_path}/{name}")
        seen[name] = (docs, spark.read.parquet(f"{tmp_path}/{name}"))
        docs = seen[name][1]
        if name != "token_files":
            assert docs.columns == COLUMNS and docs.dtypes == seen[name][0].dtypes
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    before, after = seen["quality"]
    good = before.join(labels.filter("quality = 1"), "doc_id")
    assert good.join(after, "doc_id", "left_anti").count() <= 0.05 * good.count()
    bad = before.join(labels.filter("quality = 0"), "doc_id")
    assert bad.join(after, "doc_id", "left_semi").count() <= 0.2 * bad.count()

    before, after = seen["near_duplicates"]
    found = jaccard_components(before, 5, 80)
    want = {r.component_id for r in found.filter("n_shingles > 0 and component_id is not null").collect()}
    want |= {r.doc_id for r in found.filter("n_shingles = 0").collect()}
    kept = [r.doc_id for r in after.collect()]
    assert {k for k in kept if k is not None} == want - {None} and len(kept) == len(set(kept))
    assert 9001 in kept and 9002 in kept and None in kept
    left = jaccard_components(after, 5, 80)
    assert left.filter("n_links > 0").count() == 0  # none of those that stay are near each other here

    before, after = seen["decontamination"]
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    leaks = {r.doc_id for r in queries.decontaminate.find_leaks(before, bench).collect()}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == leaks - {None}

    before, after = seen["mixing"]
    words = "coalesce(sum(regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]+')), 0) as n"
    assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    total, mixed = before.selectExpr(words).first().n, after.selectExpr(words).first().n
    assert abs(mixed - 1.5 * total) < 0.1 * total

    before, after = seen["token_files"]
    assert after.count() == before.count()
    rows = sorted(after.collect(), key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))


def test_run_is_the_stages_and_is_registered(spark, corpus):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is pipeline.run
    assert pipeline.run(spark, corpus).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_empty_corpus(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES:
        stage(spark, docs, corpus).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0


def test_each_operator_has_one_query():
    import re

    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES]
    assert numbers == list(range(1, 14))


def test_rows_without_an_id_and_ids_on_several_texts(spark, tmp_path):
    """Decisions are about rows: no null id slips through, no other text of an id goes."""
    def text(name):
        return " ".join(f"{name}{k}" for k in range(40))

    item, near = text("item"), text("near")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def left(stage, rows):
        docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
        return sorted(((r.doc_id, r.text) for r in stage(spark, docs, str(tmp_path)).collect()), key=repr)

    rows = [(None, item), (None, text("a")), (7, "so " + item), (7, text("b")), (8, None), (None, None)]
    assert left(pipeline.drop_leaks, rows) == sorted([(None, text("a")), (7, text("b")), (8, None), (None, None)], key=repr)
    rows = [(5, near), (9, near + " more"), (9, text("c")), (None, near), (None, text("d")), (None, text("d") + " more"), (None, None), (8, None), (5, near)]
    got = left(pipeline.drop_near_duplicates, rows)
    d = [t for i, t in got if i is None and t is not None]
    assert len(d) == 1 and d[0] in (text("d"), text("d") + " more")
    assert got == sorted([(5, near), (9, text("c")), (None, d[0]), (None, None), (8, None)], key=repr)
