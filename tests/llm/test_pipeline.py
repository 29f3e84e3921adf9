"""The pipeline's stages: their order, columns and effect on a small corpus."""

import random
import subprocess
import sys

import corpus_pipeline
from olapkit.llm import queries

WORDS = "the of and to in is was for on with as by at from that it be are this an".split()


def corpus():
    rng = random.Random(0)
    say = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "x", "yz"]) for _ in range(n))
    clean = [say(120) for _ in range(20)]
    return clean, [(k, t) for k, t in enumerate(clean)] + [
        (100, clean[0]), (101, clean[1] + " end"), (102, "too short"), (103, "# " * 80), (104, None),
        (105, say(60) + " a.b@c.de " + say(60))]


def test_stages_take_effect(spark, frame, tmp_dir):
    clean, rows = corpus()
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "unused")
        path = f"{tmp_dir}/{len(seen)}"
        out.write.parquet(path)
        seen.append(spark.read.parquet(path))
        docs = seen[-1]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "PII", "source mix", "packing"]
    ids = [sorted(r.doc_id for r in d.select("doc_id").distinct().collect()) for d in seen]
    assert ids[0] == [*range(20), 100, 101, 105]
    assert ids[1] == ids[2] == [*range(20), 105]
    assert all(d.columns == ["doc_id", "text", "lang", "source", "n_chars"] for d in seen[:4])
    assert "[EMAIL]" in [r.text for r in seen[2].collect() if r.doc_id == 105][0]
    assert {r.doc_id: r.text for r in seen[2].collect()}[3] == clean[3]
    tokens = {r.doc_id: 0 for r in seen[4].collect()}
    for r in seen[4].collect():
        tokens[r.doc_id] += r.length
    assert set(tokens) == set(ids[3])


def test_run_equals_its_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    pick = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    want = sum(r[2] for r in pick(docs))
    got = pick(corpus_pipeline.run(spark, sf))
    assert sum(r[2] for r in got) == want and {r[0] for r in got} == {r[0] for r in pick(docs)}


def test_all_operators_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(entry.oracle_sql())


def test_library_does_not_import_the_subpackage():
    code = "import olapkit, olapkit.plans as p, sys; p.queries(); print([m for m in sys.modules if 'llm' in m])"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert done.stdout.strip() == "[]"
