"""The corpus pipeline on a small table: every stage's decisions."""

import random

import corpus_pipeline
from framespan.llm import bpe


def test_pipeline(spark, tmp_path):
    rnd = random.Random(5)
    make = lambda n=60: " ".join(f"w{rnd.randrange(4000)}" for _ in range(n))
    passage = make(40)
    texts = {k: make() for k in range(300)}
    for k in range(0, 300, 6):
        texts[k] += " moron scum"
    texts[301] = texts[1]
    texts[302] = texts[2] + " extra"
    texts[303] = f"{make()} {passage} {make()}"
    texts[304] = f"{make()} password=abcdef0123456789abcdef01 end"
    texts[305], texts[306] = None, ""
    texts[310] = "long " + " ".join(f"w{rnd.randrange(10**6)}" for _ in range(200_000))  # over a megabyte
    rows = [(k, t, "en", f"s{k % 2}", len(t or "")) for k, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k % 6 == 0)) for k in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    kept = {k for k in texts if not (k < 300 and k % 6 == 0) and k not in (301, 302, 303)}
    assert set(found) == kept and found[310].n_tokens > 200_000
    ranks, _ = bpe.public_vocabulary()
    tokens = {i: t for t, i in ranks.items()}
    text = lambda k: "".join(bpe.decode_stream(found[k].ids, tokens))
    assert text(1) == texts[1] and "abcdef0123" not in text(304) and "[SECRET]" in text(304) and text(305) == ""
    assert all(r.n_tokens == len(r.ids) for r in found.values())
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), str(tmp_path)).columns == docs.columns


def test_pipeline_odd_rows(spark, tmp_path):
    """Repeated rows, two texts under one id, ties, extra columns with clashing names, and a stage by stage brute force."""
    rnd = random.Random(8)
    make = lambda n=40: " ".join(f"w{rnd.randrange(4000)}" for _ in range(n))
    a, b, c = make(), make(), make()
    rows = [(1, a), (1, a), (1, b), (2, b + " end"), (3, c), (3, c + " moron scum"), (4, None), (4, ""), (5, c), (6, make(3))]
    rows += [(k, make() + (" moron scum" if k % 2 else "")) for k in range(10, 120)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, th long, score double, _th int, component_id long"
    docs = spark.createDataFrame([(*r, "en", "s", len(r[1] or ""), 1, 2.0, 3, 4) for r in rows], schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, k % 2) for k in range(10, 120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, make()), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    clean = corpus_pipeline.without_toxic(spark, read, str(tmp_path))
    left = sorted((r.doc_id, r.text or "") for r in clean.collect())
    assert clean.columns == docs.columns and left == sorted((d, t or "") for d, t in rows if "moron" not in (t or ""))
    single = corpus_pipeline.one_of_each_group(spark, clean, str(tmp_path))
    # b under 1 is near b + " end" under 2; c under 3 is that under 5; repeated rows are one; texts without words stay
    first = {(1, a), (1, b), (3, c)}
    assert single.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in single.collect() if r.text and r.doc_id < 6) == sorted(first)
    assert sum(not r.text for r in single.collect()) == 2
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "lang", "source", "ids", "n_tokens"]
