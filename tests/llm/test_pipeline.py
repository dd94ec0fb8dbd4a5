import contextlib
import math

import pyarrow as pa

import corpus_pipeline
from millrace.llm import quality
from millrace.session import BATCH_BYTES, stored

from .helpers import SPACE
from .test_decontamination import plain as plain_hits
from .test_jaccard_join import plain_components
from .test_mixing import plain_targets
from .test_token_files import plain as plain_tokens

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages_agree_with_plain_versions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, frames = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), "test-stage")
        frames.append(docs)
    scored, single, clean, mixed, tokens = frames
    assert all(f.columns == columns for f in frames[:-1])

    start = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scorer = quality.fit(start, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = {r.doc_id for r in quality.score_documents(start, scorer).collect() if r.reject_chance < 0.5}
    assert {r.doc_id for r in scored.collect()} == good

    want = {i for i, _, c in plain_components(rows(scored)) if i == c}
    assert sorted(r.doc_id for r in single.collect()) == sorted(want)

    items = rows(spark.read.parquet(f"{FOLDER}/benchmark.parquet"))
    hits = {h[0] for h in plain_hits(rows(single), items) if h[-1]}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(want - hits)

    def sizes(frame):
        out = {}
        for r in frame.collect():
            out[r.source] = out.get(r.source, 0) + len(SPACE.findall(r.text or ""))
        return out

    targets = plain_targets(sizes(clean), (5.0, 2.0, 1.0), 1.5, 2)
    assert sizes(mixed) == {s: math.floor(t + 1e-9) for s, t in targets.items() if t >= 1}
    got = sorted(rows(tokens), key=lambda r: r[1])
    assert got == [r[:4] for r in plain_tokens(rows(mixed))]


def test_stages_bound_the_batches_of_workers(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(i, "x" * 100_000, "a", "b", 1) for i in range(100)],
                                 "doc_id long, text string, source string, lang string, n_chars long").coalesce(1)

    def largest(batches):
        yield pa.RecordBatch.from_pydict({"n": [max(b.nbytes for b in batches)]})

    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.unset(name)
            with contextlib.suppress(Exception):
                stage(spark, docs, "/nowhere")
            assert docs.mapInArrow(largest, "n long").first().n < BATCH_BYTES + (1 << 20)
    finally:
        spark.conf.unset(name)


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights",
        "token-ID / binary output"]
