"""The pipeline's stages one after another, against what each should keep of its input."""

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cellweave.llm import mixing, quality_rules, toxicity
from test_shingle_copies import alike, shingles
from test_simhash import reachable


def test_stages(spark):
    root = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    ids = lambda df, condition="true": sorted(r.doc_id for r in df.where(condition).select("doc_id").collect())
    quality, clean, groups, mix, pack = (f for _, f in corpus_pipeline.STAGES)
    kept = quality(spark, docs, root).checkpoint()
    assert kept.columns == columns and ids(kept) == ids(quality_rules.apply_rules(docs), "kept")
    after = clean(spark, kept, root).checkpoint()
    model = toxicity.train(kept, spark.read.parquet(f"{root}/labels.parquet"))
    assert after.columns == columns and ids(after) == ids(toxicity.severity(kept, model), "not toxic")
    one = groups(spark, after, root).checkpoint()
    texts = sorted((r.doc_id, r.text) for r in after.select("doc_id", "text").collect())
    sets = [shingles(t) for _, t in texts]
    label = reachable(len(texts), [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if alike(sets[a], sets[b])])
    assert one.columns == columns and ids(one) == [texts[i][0] for i in sorted(set(label))]
    mixed = mix(spark, one, root).checkpoint()
    assert mixed.columns == columns and ids(mixed) == ids(mixing.mix(one), "cell_kept")
    rows, library = mixed.collect(), Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {r.doc_id: len(x.ids) + 1 for r, x in zip(rows, library.encode_batch([r.text for r in rows], add_special_tokens=False), strict=True)}
    found = {}
    for r in pack(spark, mixed, root).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == lengths
    assert {r.doc_id for r in corpus_pipeline.run(spark, root).collect()} == set(lengths)


def test_empty_and_odd_tables(spark, tmp_path, make, odd):
    """No document, or none with a label of both classes, is no error in any stage."""
    for name, docs in (("none", make([])), ("odd", make(odd + [None, "Twelve words that no other text has, so that it stays to the end.", "x y z " * 9], ids=[*range(len(odd)), None, None, 3]))):
        root = str(tmp_path / name)
        docs.withColumns({"group": F.lit(1), "cell_kept": F.lit(True), "t": F.lit("t")}).write.parquet(f"{root}/documents.parquet")
        spark.createDataFrame([(1, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
        rows = corpus_pipeline.run(spark, root)
        assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and (rows.count() == 0) == (name == "none")
