import sys
from pathlib import Path

import pytest
from .llm_helpers import SF

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline as C  # noqa: E402

from settleline.llm import decontam, langid, packing, queries, simhash  # noqa: E402


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    kept = docs
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, kept, SF)
        assert out.columns == columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        rows = out.collect()
        assert {r.doc_id for r in rows} <= ids, name
        ids = {r.doc_id for r in rows}
        kept = spark.createDataFrame(rows, docs.schema)
    final = [r.text for r in kept.collect()]
    assert decontam.contaminated(kept, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    groups = simhash.simhash_groups(kept).collect()
    assert len({r.component_id for r in groups}) == len(groups)
    assert all(any(c.isalpha() for c in t) for t in final)
    packed = C.STAGES[-1][1](spark, kept, SF)
    assert {r.doc_id for r in packed.collect()} == ids


def test_run(spark):
    out = C.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 50


def test_clean_documents_stay(spark):
    """Documents with lines of their own, a known language and no test item all reach the end."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lone = {r.doc_id for r in docs.collect()}
    for r in simhash.simhash_groups(docs).collect():
        if r.component_id != r.doc_id:
            lone -= {r.doc_id, r.component_id}
    lone -= {r.doc_id for r in decontam.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    lone -= {r.doc_id for r in langid.language_of_documents(docs).where(f"lang_pred = 'und' OR score < {langid.MIN_SCORE}").collect()}
    got = {r.doc_id for r in C.run(spark, SF).collect()}
    assert len(lone - got) <= 0.02 * len(lone)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {*queries.QUERIES, "pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("pages", "documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{t}.parquet')")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    rows = sorted(map(str, want.fetchall()))
    out = queries.QUERIES[name](spark, "/root/testdata/sf0.01")
    assert sorted(out.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in out.select(*columns).collect()) == rows


def test_packing_matches_the_registered_query(spark):
    a = queries.op3_best_fit_packing(spark, SF)
    assert a.count() == packing.pack(spark.read.parquet(f"{SF}/documents.parquet")).count()


def test_scratch_tables_go(spark):
    """What a block made goes at its end but for what it kept, which goes with the next one."""
    from settleline.llm.common import cut, scratch, staged
    with scratch(spark) as made:
        one = made.keep(staged(spark.range(5), "one"))
        two = staged(one.where("id > 1"), "two")
        three = cut(two.groupBy().count())
        assert three.first()[0] == 3
        folders = [Path(path.removeprefix("file:")) for _, path in made.made]
        assert len(folders) == 2 and all(f.is_dir() for f in folders)
    assert not any(f.exists() for f in folders) and one.count() == 5
    (kept,) = [Path(path.removeprefix("file:")) for _, path in made.kept]
    with scratch(spark, made.kept):
        assert kept.is_dir() and one.count() == 5
    assert not kept.exists()
