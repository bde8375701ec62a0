from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from wakeline.llm import packing, quality, simhash


@pytest.fixture(scope="module")
def folder(spark, make, prose, tmp_path_factory):
    """A small corpus: clean documents, junk, copies, a shared passage and personal data."""
    passage = prose("shared", 80)
    rows = [(i, prose(i, 140)) for i in range(60)]
    rows += [(100 + i, " ".join(w + "##" for w in prose(f"junk{i}", 120).split())) for i in range(40)]
    rows += [(200 + i, prose(i, 140)) for i in range(5)]
    rows += [(300, prose("x", 90) + " " + passage), (301, passage + " " + prose("y", 90))]
    words = prose("near", 150).split()
    rows += [(500, " ".join(words)), (501, " ".join([*words[:40], "changed", *words[41:]])), (502, " ".join([*words[:90], *words[92:]]))]
    rows += [(400, prose("z", 90) + " mail ann.lee@mail3.example.com now")]
    out = tmp_path_factory.mktemp("corpus")
    make(rows).write.parquet(str(out / "documents.parquet"))
    labels = [(d, int(not 100 <= d < 200)) for d, _ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int").withColumn("toxic", F.lit(0)).write.parquet(str(out / "labels.parquet"))
    return str(out), dict(rows)


def test_stages(spark, folder, tmp_path):
    path, texts = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert name == "pack" or docs.columns == columns
    clean = {d for d in texts if not 100 <= d < 200}
    assert seen[0] == clean
    assert seen[1] == clean - {200, 201, 202, 203, 204, 501, 502}
    assert seen[2] == seen[3] == seen[4] == seen[1]
    final = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "personal_data")).collect()}
    assert all(final[d] == texts[d] for d in seen[4] if d not in (301, 400))
    assert len(final[301].split()) <= 91 and "ann.lee" not in final[400]


def test_run(spark, folder):
    path, _ = folder
    got = corpus_pipeline.run(spark, path)
    assert got.columns == [p.split()[0] for p in packing.SCHEMA.split(", ")]
    assert got.where("start = 0").count() == 64


def test_quality_on_the_small_table(spark):
    """The stage keeps what its operator says."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, "/root/testdata/sf0.001")
    rules = quality.fit(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    assert kept.count() == quality.judge(docs, rules).where("kept").count() < docs.count()


def test_near_copies_on_the_test_table(spark):
    """Every pair of a five-word Jaccard of 0.8 or more, by an exact search, loses one of its documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {r.doc_id: frozenset(simhash.shingle_hashes(r.text, 5).tolist()) for r in docs.collect()}
    ids = sorted(sets)
    held, links = {}, set()
    for d in ids:
        for h in sets[d]:
            held.setdefault(h, []).append(d)
    for a in ids:
        met = Counter(b for h in sets[a] for b in held[h] if b > a)
        links |= {(a, b) for b, n in met.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)}
    groups = {r.doc_id: r.component_id for r in simhash.similar(docs).collect()}
    assert len(links) > 20 and sum(groups[a] == groups[b] for a, b in links) >= 0.98 * len(links)
    linked = {d for link in links for d in link}
    assert all(groups[d] == d for d in ids if d not in linked)


CLASH = ("a", "b", "lo", "hi", "words", "kept", "entities", "_before", "n_words", "rule", "fp", "shard", "spans", "_cut")


def test_odd_rows_and_clashing_columns_through_every_stage(spark, make, odd_rows, prose, tmp_path):
    """No stage changes, drops or stumbles over a column of the user's."""
    docs = make([*odd_rows, *((100 + i, prose(i % 20, 150)) for i in range(30))])
    for name in CLASH:
        docs = docs.withColumn(name, F.lit("mine"))
    spark.createDataFrame([(100 + i, 1) for i in range(20)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, docs.where("false")):
            out = stage(spark, rows, str(tmp_path))
            assert out.columns == docs.columns, name
            got = out.collect()
            assert all(r[c] == "mine" for r in got for c in CLASH), name
        assert not got
    assert corpus_pipeline.run(spark, str(tmp_path)).where("start = 0").count() == 20
    empty = tmp_path / "empty"
    docs.where("false").write.parquet(str(empty / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(empty / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
