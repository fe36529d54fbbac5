"""Each stage of the corpus pipeline against brute force on what the stage before it kept."""

from collections import Counter

import corpus_pipeline
from test_text_operators import base_spans, classes, contaminated
from test_tokens import check_pieces

from ledgerline.llm import quality
from ledgerline.llm.store import written


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near duplicates", "decontamination", "personal data", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = written(stage(spark, docs, sf), "test-stage")
        if name == "packing":
            check_pieces(out.collect(), rows, 2048)
            break
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        got = {r["doc_id"]: r for r in out.collect()}
        if name == "quality":
            scores = {r["doc_id"]: r["predicted"] for r in quality.scored(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
            assert set(got) == {i for i, p in scores.items() if p}
        elif name == "near duplicates":
            label = classes(rows)
            groups = Counter(label[k] for k, (i, _) in enumerate(rows) if i in got)
            assert set(groups) == set(label) and set(groups.values()) == {1}
        elif name == "decontamination":
            assert set(map(str, got)) == {i for i, *_, bad in contaminated(rows, bench) if not bad}
        else:
            assert set(got) == {i for i, _ in rows}
            for i, text in rows:
                values = [text[int(s) : int(e)] for _, s, e in (x.split(":") for x in base_spans(text))]
                assert not base_spans(got[i]["text"]) and (values or "[" in got[i]["text"] or got[i]["text"] == text)
                assert got[i]["n_chars"] == len(got[i]["text"])
        kept[name] = len(got)
        docs = out
    assert kept["personal data"] == kept["decontamination"] > 100


def test_run(spark, sf):
    pieces = corpus_pipeline.run(spark, sf)
    ends = pieces.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert len(ends) > 1 and sum(r[1] == 2048 for r in ends) >= len(ends) - 1
    again = corpus_pipeline.run(spark, sf)
    both = [sorted(map(str, df.drop("ids").collect())) for df in (pieces, again)]  # the first run's tables are still there
    assert both[0] == both[1]
