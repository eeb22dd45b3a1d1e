"""The pipeline's stages against the operators they call."""

import corpus_pipeline
from newsmarket.llm import decontaminate, mixing, near_dup, toxicity
from newsmarket.llm.common import read, shared_dir, stored

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, path = read(spark, SF, "documents"), shared_dir(spark)
    labels, bench = read(spark, SF, "labels"), read(spark, SF, "benchmark")
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dup", "decontaminate", "mixing", "token_output"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "toxicity":
            want = ids(toxicity.scores(docs, labels).where("predicted = 0"))
        elif name == "near_dup":
            want = ids(near_dup.near_duplicates(docs).where("kept"))
        elif name == "decontaminate":
            want = sorted(set(ids(docs)) - set(ids(decontaminate.leaks(docs, bench))))
        elif name == "mixing":
            rates = mixing.rates(docs, mixing.quality_domains(labels), mixing.WEIGHTS)
            want = sorted(r["doc_id"] for r in rates.collect() for _ in range(r["copies"]))
        else:
            want = ids(docs)
        assert ids(out) == want, name
        if name != "token_output":
            assert out.columns == docs.columns
            docs = stored(out, f"{path}/{name}")
    assert docs.count() > 100
