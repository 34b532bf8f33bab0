"""The pipeline's stages against their rules on a small corpus, and the registered queries."""

import hashlib
import random

import corpus_pipeline
import public_tokenizers as P
import tiktoken

from hiremart.llm.bpe import load_ranks
from hiremart.llm.queries import oracle_sql, queries

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "suffix_dedup", "decontaminate", "bpe"]


def test_queries_are_registered():
    assert [int(n[2:].split("_")[0]) for n in queries()] == list(range(1, 14))
    assert set(oracle_sql()) <= set(queries())


def test_pipeline_keeps_clean_documents_and_acts(spark, scratch):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=rng.randint(3, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    docs = {k: text(60) for k in range(400)}
    toxic = [k for k in range(400) if k % 5 == 0]
    for k in toxic:
        docs[k] += " zzzbad yyyworse"
    docs[1001] = docs[1]                                            # a copy
    docs[1002] = docs[2] + " and a tail"                            # a near copy
    passage, item = text(70), text(30)
    docs[1003] = text(40) + " " + passage
    docs[1004] = text(40) + " " + passage + " " + text(40)          # a repeated passage
    docs[1005] = text(50) + " " + item                              # contaminated
    docs[1006] = text(50)
    rows = [(k, t, "en", "s", len(t)) for k, t in docs.items()] + [(1007, None, None, None, None), (1008, "", "en", "s", 0)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{scratch}/documents.parquet")
    labels = [(k, 1, int(k in toxic)) for k in range(400)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    frame = spark.read.parquet(f"{scratch}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, frame, scratch)
        assert out.columns == frame.columns, name
        out.write.parquet(f"{scratch}/{name}")
        frame = spark.read.parquet(f"{scratch}/{name}")
    left = {r.doc_id: r.text for r in frame.collect()}
    clean = {k: t for k, t in docs.items() if k < 400 and k not in toxic} | {1003: docs[1003], 1006: docs[1006]}
    assert all(left[k] == t for k, t in clean.items())
    assert not set(toxic) & set(left) and not {1001, 1002, 1005} & set(left)
    assert passage[40:-40] not in left[1004] and left[1004].startswith(docs[1004][:100])
    assert 1007 in left and 1008 in left
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, scratch).collect()}
    assert got.keys() == left.keys()
    for k, r in got.items():
        assert r.ids == encoding.encode_ordinary(left[k] or "")
        assert r.decoded_sha256 == hashlib.sha256((left[k] or "").encode()).hexdigest()
